"""One identity for rows that share any contact key (tier-2 lead map).

Rows are linked by equal values of any of several contact columns (an e-mail, a
phone): a lead known by phone and an opportunity known by e-mail belong together if
a third row has both. Rows and contact values form a bipartite graph, so a value that
many rows share costs a link a row, never a pair of rows. Each round every value takes
the least label of its rows and every row the least of its values, and then labels
follow their own labels, so a chain shrinks by more than half a round. Rounds are
written to the shared folder: none hangs on the plan of the one before.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_once


def contact_links(rows: DataFrame, id_col: str, contacts: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """(row, value): a row's contact values, told apart by column and by ``within`` (e.g. the instance)."""
    scope = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in within]
    # lengths before values: no two lists of parts give one text
    key = lambda c: F.concat_ws("", *[F.concat(F.length(x).cast("string"), F.lit(":"), x) for x in (F.lit(c), *scope, F.col(c).cast("string"))])
    values = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), key(c)) for c in contacts]))
    return rows.select(F.col(id_col).alias("row"), F.explode(values).alias("value")).distinct()


def identities(rows: DataFrame, id_col: str, contacts: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """(id, identity): the least id of the rows that a row is linked with through contact values,
    over any number of rows between; its own id for a row without contacts. Ids are unique."""
    links = written_once(contact_links(rows, id_col, contacts, within))
    # values of one row link nothing
    shared = links.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    links = written_once(links.join(shared.select("value"), "value", "left_semi"))
    labels = written_once(links.groupBy("row").agg(F.min("row").alias("label")))
    while True:
        least = links.join(labels, "row").groupBy("value").agg(F.min("label").alias("label"))
        near = written_once(links.join(least, "value").groupBy("row").agg(F.min("label").alias("label")))
        ahead = near.select(F.col("row").alias("label"), F.col("label").alias("next"))
        jumped = written_once(near.join(ahead, "label").select("row", F.least("label", "next").alias("label")))
        changed = jumped.join(labels.withColumnRenamed("label", "old"), "row").filter("label <> old")
        labels, done = jumped, changed.isEmpty()
        if done:
            break
    out = rows.select(F.col(id_col).alias("row")).join(labels, "row", "left")
    return out.select(F.col("row").alias(id_col), F.coalesce("label", "row").alias("identity"))


def any_contact(contacts: Sequence[str]):
    """Rows that have a contact at all."""
    return functools.reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in contacts])

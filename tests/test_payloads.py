"""Payloads of any depth as tables and back, and identities over several contact keys."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldwise.operators.identity import contact_links, identities
from fieldwise.sources.nested import child_tables

CHARGE = "struct<name:string,total:double>"
CHILDREN = ["payments", "contacts", "surveys", "documents", "files", "photos", "notes"]
DDL = (
    "id string, status bigint, customer struct<name:string,phones:array<string>>, "
    f"jobs array<struct<number:string,est:array<{CHARGE}>,act:array<{CHARGE}>,crew:array<string>,stops:array<struct<street:string,codes:array<bigint>>>>>, "
    + ", ".join(f"{c} array<struct<kind:bigint,text:string>>" for c in CHILDREN)
)


def made(r):
    maybe = lambda d, k, v: d.update({k: v}) if r.random() < 0.8 else None
    items = lambda: [{"kind": r.randrange(9), "text": r.choice(["a", 'q"uote', "é", ""])} for _ in range(r.randrange(3))]
    charges = lambda: [{"name": "c", "total": 1.5}] * r.randrange(3)
    doc = {"id": str(r.randrange(99)), "status": r.randrange(60)}
    maybe(doc, "customer", {"name": "N", "phones": ["1", "2"][: r.randrange(3)], "vip": True})
    jobs = []
    for _ in range(r.randrange(3)):
        job = {"number": "J", "est": charges(), "crew": ["x"] * r.randrange(3), "later": {"deep": [1, {"k": 2}]}}
        maybe(job, "act", charges())
        maybe(job, "stops", [{"street": "s", "codes": [1, 2, 3][: r.randrange(4)], "zip": "9"} for _ in range(r.randrange(3))])
        jobs.append(job)
    maybe(doc, "jobs", jobs)
    for c in CHILDREN:
        maybe(doc, c, items())
    maybe(doc, "unknown", [1, "two", {"three": 3}])
    if r.random() < 0.2:
        doc["status"] = "not a number"
    return doc


def rebuilt(tables, kind):
    """The payloads from the tables' rows."""
    rows = {path: [r.asDict(recursive=True) for r in df.withColumn("_surplus", F.to_json("_surplus") if path not in SCALARS else F.col("_surplus").cast("string")).collect()] for path, df in tables.items()}
    by_parent = {}
    for path, held in rows.items():
        for r in held:
            by_parent.setdefault((path, r["_root_key"], tuple(r.get("_parent_idx") or ())), []).append(r)

    def build(row, kind, path, place):
        doc = {}

        def put(at, struct, values, prefix):
            for f in struct.fields:
                name = prefix + f.name
                if isinstance(f.dataType, T.StructType):
                    inner = {}
                    put(inner, f.dataType, (values or {}).get(f.name), name + ".")
                    if inner or (values or {}).get(f.name) is not None:
                        at[f.name] = inner
                elif isinstance(f.dataType, T.ArrayType):
                    if row[f"_n_{name}"] is not None:
                        child = f"{path}.{name}" if path else name
                        kids = sorted(by_parent.get((child, row["_root_key"], place), []), key=lambda k: k["_list_idx"])
                        el = f.dataType.elementType
                        at[f.name] = [build(k, el, child, (*place, k["_list_idx"])) if isinstance(el, T.StructType) else k["value"] for k in kids]
                        assert len(kids) == row[f"_n_{name}"]
                elif (values or {}).get(f.name) is not None:
                    at[f.name] = values[f.name]

        put(doc, kind, row, "")
        for key, value in json.loads(row["_surplus"]).items():
            *outer, last = key.split(".")
            at = doc
            for o in outer:
                at = at.setdefault(o, {})
            at[last] = value
        return doc

    return {r["_root_key"]: build(r, kind, "", ()) for r in rows[""]}


SCALARS = {"customer.phones", "jobs.crew", "jobs.stops.codes"}


def test_one_call_gives_the_parent_and_all_children_and_loses_nothing(spark):
    r = random.Random(3)
    docs = {i: made(r) for i in range(120)}
    kind = spark.createDataFrame([], DDL).schema
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs.items()], "key bigint, payload string").withColumn("_v", F.lit("x"))
    tables = child_tables(df, "payload", ["key"], kind)
    assert set(tables) == {"", "customer.phones", "jobs", "jobs.est", "jobs.act", "jobs.crew", "jobs.stops", "jobs.stops.codes", *CHILDREN}
    assert len(tables) - 1 >= 12
    assert rebuilt(tables, kind) == docs


def test_payloads_that_are_no_object(spark):
    kind = spark.createDataFrame([], "id string, xs array<bigint>").schema
    df = spark.createDataFrame([(1, None), (2, "not json"), (3, "[1]"), (4, '{"id": 7, "xs": [1, "a", null]}'), (5, '{"xs": {}}')], "key bigint, payload string")
    tables = child_tables(df, "payload", ["key"], kind)
    top = {r._root_key: (r.id, r._n_xs, r.s) for r in tables[""].withColumn("s", F.to_json("_surplus")).collect()}
    assert top[4] == ("7", 3, "{}") and top[5] == (None, None, '{"xs":{}}') and top[1] == top[2] == (None, None, "{}")
    xs = {(r._root_key, r._list_idx): (r.value, r.s) for r in tables["xs"].withColumn("s", F.to_json("_surplus")).collect()}
    assert xs == {(4, 0): (1, None), (4, 1): (None, '"a"'), (4, 2): (None, "null")}
    assert all(t.count() == 0 for t in child_tables(df.limit(0), "payload", ["key"], kind).values())


def plain_identities(rows):
    parent = {i: i for i, *_ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    first = {}
    for i, inst, mail, phone in rows:
        for v in (("m", inst, mail), ("p", inst, phone)):
            if v[2] is not None:
                a, b = find(first.setdefault(v, i)), find(i)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def test_identities_equal_union_find(spark):
    r = random.Random(6)
    rows = [(i, r.choice("ab"), r.choice([None, f"m{r.randrange(80)}"]), r.choice([None, f"p{r.randrange(80)}"])) for i in range(160)]
    rows += [(1000 + i, "c", f"m{i}", f"m{i + 1}") for i in range(40)]  # an e-mail is no phone
    rows += [(2000 + i, "d", f"x{(i + 1) // 2}", f"y{i // 2}") for i in range(41)]  # one long chain
    rows += [(3000 + i, "e", "office", None) for i in range(300)]  # a value that many share
    df = spark.createDataFrame(rows, "id bigint, inst string, mail string, phone string").withColumn("row", F.lit("x")).withColumn("label", F.lit(1))
    got = {x.id: x.identity for x in identities(df, "id", ["mail", "phone"], ["inst"]).collect()}
    assert got == plain_identities(rows)
    assert contact_links(df, "id", ["mail", "phone"], ["inst"]).count() <= 2 * len(rows)
    assert identities(df.limit(0), "id", ["mail"]).count() == 0


def test_links_by_phone_only_and_by_mail_only(spark):
    rows = [(1, "a", None, "555"), (2, "a", "e@x", None), (3, "a", "e@x", "555"), (4, "a", "f@x", None), (5, "b", "e@x", "555")]
    df = spark.createDataFrame(rows, "id bigint, inst string, mail string, phone string")
    got = {x.id: x.identity for x in identities(df, "id", ["mail", "phone"], ["inst"]).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}

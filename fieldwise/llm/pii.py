"""Operator 8: personal data by weak supervision, in DataFrame functions alone.

Candidate spans come from one pattern a kind: the base kinds email, ip, card
and phone, and a loose pattern for what they miss (credentials, numbers in the
style of social security and of local phones, masked addresses). Five labelers
vote on each candidate: a regex or check digit, a gazetteer of words that
announce personal data, the characters around it, its variety of characters,
and a gazetteer of words that announce versions and sections. Counts of vote
patterns, a few hundred rows at most, go to the driver, where expectation
maximisation estimates each labeler's reliability and each pattern's
probability, and a logistic span classifier is trained on these as soft labels.
It then decides over every candidate of every text.

Base spans (a base match that passes its check) stay whatever the classifier
says; candidates it accepts are added where they overlap no base span.

Spans are offsets in code points, end exclusive. A text is read by replacing
matches with themselves between two marks and splitting there, so offsets are
sums of piece lengths; marks that occur in a text count as other characters.
Patterns use possessive repetition and anchored starts where these match alike,
so long runs neither recurse nor backtrack.

Defined results: null and empty texts have no spans. Repeated rows get equal
results. Without any candidate the classifier accepts nothing. Other columns
pass through; names that clash with the helper columns (they start with
``_pii_``) are not supported.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"
LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = ("email", "ip", "card", "phone", "secret", "number")
N_BASE = 4
#: Base patterns, as the contract has them but for possessive and anchored forms.
PATTERNS = (
    rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must hold for a pattern to be worth trying.
GUARDS = ("@", r"[0-9]\.[0-9]+\.[0-9]", r"[0-9][\x20-]?[0-9]", r"\+[0-9]")
SECRET = (
    r"(?:password|passwd|token|secret|api_?key)\x20?[=:]\x20?\"?[A-Za-z0-9_-]{8,}+\"?"
    r"|(?<![A-Za-z0-9])[A-Z]{4}[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])"
)
NUMBER = r"(?<![0-9.+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{2,3}[\x20.-][0-9]{4}(?![0-9.-])"
EXTRA_GUARDS = (r"(?:password|passwd|token|secret|api_?key)\x20?[=:]|[A-Z0-9]{20}|[0-9a-f]{32}", r"[0-9][0-9)][\x20.-]*[0-9]{2,3}[\x20.-][0-9]{4}")
ANNOUNCED = r"(?i)(?:passw(?:or)?d|token|secret|key|tel|phone|fon|call|mobile|mail|contact|card|iban|ssn|server|host|addr(?:ess)?)\W{0,4}$"
EDITION = r"(?i)(?:version|licen[cs]e|section|chapter|page|release|\bv)\W{0,3}$"
BOUNDED = r"(?:^|[\s\"'(\[<:=;,])$"
LEFT_CHARS = 24
LABELERS = ("checked", "announced", "bounded", "varied", "no_edition")
EM_ROUNDS = 60
#: Items of a part of a long array (even: see ``_between``).
PART = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _cut(items: Column) -> Column:
    """An array in parts of ``PART`` items. Folds over parts, then over the parts' items, append to
    short arrays and strings only, where one fold over all items would copy its result at every step."""
    n = F.size(items)
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(PART))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(items, i, F.lit(PART)))


def _running(values: Column, first: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What holds before each of the values, and after the last one (one value a part of an array)."""
    begun = F.struct(first.alias("at"), F.array(first).alias("out"))

    def step(a: Column, v: Column) -> Column:
        return _let(add(a["at"], v), lambda at: F.struct(at.alias("at"), F.concat(a["out"], F.array(at)).alias("out")))

    return F.aggregate(values, begun, step, lambda a: a["out"])


def _between(text: Column, pattern: str) -> Column:
    """Matches of a pattern as (start, end, s, left), ``left`` the characters before."""
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, OTHER * 2), pattern, f"{OPEN}$0{CLOSE}")
    pieces = F.split(marked, f"[{OPEN}{CLOSE}]", -1)
    none = F.array().cast("array<struct<start:int,end:int,s:string,left:string>>")

    def found_in(part: Column, at: Column) -> Column:
        """Parts begin outside a match: they hold pairs of what is between matches and a match."""
        first = F.struct(at.alias("at"), F.lit(False).alias("inside"), F.lit("").alias("left"), none.alias("out"))

        def step(a: Column, p: Column) -> Column:
            end = a["at"] + F.length(p)
            found = F.struct(a["at"].alias("start"), end.alias("end"), p.alias("s"), a["left"].alias("left"))
            return F.struct(
                end.alias("at"),
                (~a["inside"]).alias("inside"),
                F.right(p, F.lit(LEFT_CHARS)).alias("left"),
                F.when(a["inside"], F.concat(a["out"], F.array(found))).otherwise(a["out"]).alias("out"),
            )

        return F.aggregate(part, first, step, lambda a: a["out"])

    def of_parts(parts: Column) -> Column:
        sizes = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda n, p: n + F.length(p)))
        return _let(_running(sizes, F.lit(0), lambda a, n: a + n), lambda at: F.flatten(F.transform(parts, lambda part, k: found_in(part, F.get(at, k)))))

    return _let(pieces, lambda held: _let(_cut(held), of_parts))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _ip_ok(s: Column) -> Column:
    def part(x: Column) -> Column:
        bare = F.regexp_replace(x, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(s, "[.]"), part)


def _luhn(d: Column) -> Column:
    back = F.reverse(d)

    def add(total: Column, i: Column) -> Column:
        v = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _card_ok(s: Column) -> Column:
    d = _digits(s)
    return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)


def _phone_ok(s: Column) -> Column:
    return F.length(_digits(s)).between(9, 15)


#: The regex or check-digit labeler of each kind; for base kinds it is the contract's check.
CHECKS: tuple[Callable[[Column], Column], ...] = (
    lambda s: F.lit(True),
    _ip_ok,
    _card_ok,
    _phone_ok,
    lambda s: s.rlike(r"^(?:[A-Z]{4}[0-9A-Z]{16}|\"?[0-9a-f]{32,}\"?)$|[=:]\x20?\"?(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{8,}\"?$"),
    lambda s: s.rlike(r"^\([0-9]{3}\)\x20?[0-9]{3}[\x20-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
)


def _candidates(text: Column, kind: int) -> Column:
    """A kind's candidates with their votes: (kind, start, end, size, checked, announced, ...)."""
    pattern = (*PATTERNS, SECRET, NUMBER)[kind]
    guard = (*GUARDS, *EXTRA_GUARDS)[kind]
    worth = text.contains(guard) if guard == "@" else text.rlike(guard)
    none = F.array().cast("array<struct<start:int,end:int,s:string,left:string>>")
    found = F.when(worth, _between(text, pattern)).otherwise(none)

    def votes(x: Column) -> Column:
        s, left = x["s"], x["left"]
        size = F.length(s)
        yes = {
            "checked": CHECKS[kind](s),
            "announced": left.rlike(ANNOUNCED) | s.rlike(r"(?i)^(?:passw(?:or)?d|token|secret|api_?key)"),
            "bounded": left.rlike(BOUNDED),
            "varied": F.size(F.array_distinct(F.split(s, ""))) >= 6,
            "no_edition": ~left.rlike(EDITION),
        }
        return F.struct(
            F.lit(kind).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.when(size < 8, 0).when(size < 16, 1).otherwise(2).alias("size"),
            *[v.cast("int").alias(name) for name, v in yes.items()],
        )

    return F.transform(found, votes)


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_pii_found``: all candidates with their votes, by kind, then start."""
    rows = docs.withColumn("_pii_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = F.concat(*[_candidates(F.col("_pii_text"), k) for k in range(len(KINDS))])
    return rows.withColumn("_pii_found", found).drop("_pii_text")


class Classifier:
    """Labelers' reliabilities by expectation maximisation, and a logistic span classifier."""

    def __init__(self, counts: Sequence[tuple[tuple[int, ...], int]]) -> None:
        """``counts``: ((kind, size, vote, vote, ...), number of candidates)."""
        self.weights: list[float] | None = None
        self.reliability: list[tuple[float, float]] = []
        if counts:
            self._train(counts, self._em(counts))

    def _em(self, counts) -> list[float]:
        """P(personal data) of each pattern; votes are taken as independent given the truth."""
        n_votes = len(LABELERS)
        prior = {k: 0.5 for k in range(len(KINDS))}
        rate = [(0.8, 0.3)] * n_votes  # P(vote | personal), P(vote | not)
        post = [0.5] * len(counts)
        for _ in range(EM_ROUNDS):
            for i, (p, _) in enumerate(counts):
                a, b = math.log(prior[p[0]]), math.log(1 - prior[p[0]])
                for v, (yes, no) in zip(p[2:], rate, strict=True):
                    a += math.log(yes if v else 1 - yes)
                    b += math.log(no if v else 1 - no)
                post[i] = 1 / (1 + math.exp(max(-50.0, min(50.0, b - a))))
            for k in prior:
                mine = [(q, n) for (p, n), q in zip(counts, post, strict=True) if p[0] == k]
                prior[k] = (1 + sum(q * n for q, n in mine)) / (2 + sum(n for _, n in mine))
            rate = []
            for j in range(n_votes):
                yes = [(p[2 + j], q * n, (1 - q) * n) for (p, n), q in zip(counts, post, strict=True)]
                rate.append(
                    (
                        (1 + sum(w for v, w, _ in yes if v)) / (2 + sum(w for _, w, _ in yes)),
                        (1 + sum(w for v, _, w in yes if v)) / (2 + sum(w for _, _, w in yes)),
                    )
                )
        self.reliability = rate
        return post

    @staticmethod
    def features(pattern: Sequence[int]) -> list[float]:
        kind, size, *votes = pattern
        return [1.0, *[float(kind == k) for k in range(1, len(KINDS))], *[float(size == s) for s in (1, 2)], *map(float, votes)]

    def _train(self, counts, post: list[float], rounds: int = 400) -> None:
        """Weighted logistic regression on soft labels, by gradient steps with momentum."""
        rows = [(self.features(p), n, q) for (p, n), q in zip(counts, post, strict=True)]
        total = float(sum(n for _, n, _ in rows))
        w, speed = [0.0] * len(rows[0][0]), [0.0] * len(rows[0][0])
        for _ in range(rounds):
            gradient = [0.01 * x / total for x in w]
            for f, n, q in rows:
                z = sum(a * b for a, b in zip(w, f, strict=True))
                miss = (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - q) * n / total
                for i, x in enumerate(f):
                    gradient[i] += miss * x
            speed = [0.9 * s - 0.8 * g for s, g in zip(speed, gradient, strict=True)]
            w = [a + s for a, s in zip(w, speed, strict=True)]
        self.weights = w

    def accepts(self, x: Column) -> Column:
        """Whether a candidate struct is personal data (probability of one half or more)."""
        if self.weights is None:
            return F.lit(False)
        w = iter(self.weights)
        z = F.lit(next(w))
        for k in range(1, len(KINDS)):
            z = z + F.when(x["kind"] == k, F.lit(next(w))).otherwise(0.0)
        for s in (1, 2):
            z = z + F.when(x["size"] == s, F.lit(next(w))).otherwise(0.0)
        for name in LABELERS:
            z = z + x[name] * F.lit(next(w))
        return z >= 0


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """A classifier from the vote patterns of all candidates of all texts."""
    keys = ["kind", "size", *LABELERS]
    x = with_candidates(docs.select(text_col), text_col).select(F.explode("_pii_found").alias("x"))
    counts = x.groupBy(*[F.col(f"x.{k}").alias(k) for k in keys]).count()
    # at most kinds * sizes * 2 ** labelers rows
    return Classifier(sorted((tuple(r[k] for k in keys), r["count"]) for r in counts.collect()))


def find(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_pii_base`` and ``_pii_all``: base spans and all spans, as (kind, start, end)."""
    rows = with_candidates(docs, text_col)
    span = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    is_base = lambda x: (x["kind"] < N_BASE) & (x["checked"] == 1)
    rows = rows.withColumn("_pii_base", F.transform(F.filter("_pii_found", is_base), span))
    meets = lambda b, x: (b["start"] < x["end"]) & (x["start"] < b["end"])

    def extent(part: Column) -> Column:
        start, end = F.array_min(F.transform(part, lambda b: b["start"])), F.array_max(F.transform(part, lambda b: b["end"]))
        return F.struct(start.alias("start"), end.alias("end"), part.alias("spans"))

    # base spans in parts with their extents: a candidate is held against the parts that it meets
    rows = rows.withColumn("_pii_parts", F.transform(_cut(F.array_sort(F.transform("_pii_base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))), extent))
    over = lambda x: F.exists("_pii_parts", lambda p: meets(p, x) & F.exists(p["spans"], lambda b: meets(b, x)))
    added = F.filter("_pii_found", lambda x: ~is_base(x) & classifier.accepts(x) & ~over(x))
    rows = rows.withColumn("_pii_all", F.array_sort(F.concat("_pii_base", F.transform(added, span))))
    return rows.drop("_pii_found", "_pii_parts")


def joined(spans: str) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def masked(text_col: str, spans: str = "_pii_all") -> Column:
    """The text with every span replaced by its kind in angle brackets; of spans that overlap, the
    one that starts first gives the name and all are covered."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def fresh(part: Column, begin: Column, end: Column) -> Column:
        """The masked text between two positions, which the part's spans cover."""

        def fold(cut: Column) -> Column:
            first = F.struct(begin.alias("at"), F.lit("").alias("out"))

            def step(a: Column, x: Column) -> Column:
                before = F.substring(cut, a["at"] - begin + 1, x["start"] - a["at"])
                more = F.concat(a["out"], before, F.element_at(names, x["kind"] + 1))
                return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(x["start"] >= a["at"], more).otherwise(a["out"]).alias("out"))

            return F.aggregate(part, first, step, lambda a: a["out"])

        return _let(F.substring(text, begin + 1, end - begin), fold)

    def of_parts(parts: Column) -> Column:
        ends = F.transform(parts, lambda part: F.array_max(F.transform(part, lambda x: x["end"])))

        def whole(at: Column) -> Column:
            parts_out = F.transform(parts, lambda part, k: fresh(part, F.get(at, k), F.get(at, k + 1)))
            return F.concat(F.array_join(parts_out, ""), F.substring(text, F.element_at(at, -1) + 1, F.length(text)))

        return _let(_running(ends, F.lit(0), lambda a, e: F.greatest(a, e)), whole)

    return F.when(F.size(spans) > 0, _let(_cut(by_start), of_parts)).otherwise(F.col(text_col))


def report(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    rows = find(docs.select(id_col, text_col), classifier, text_col)
    number = lambda k: F.size(F.filter("_pii_base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return rows.select(
        id_col, *[number(k) for k in range(N_BASE)], F.sha2(joined("_pii_base").cast("binary"), 256).alias("base_sha256"), joined("_pii_all").alias("spans")
    )

"""Personal data: candidate spans, boosted trees on format and context, redaction.

Base patterns with their checks give spans that always stay. Wide generators propose
further candidates that may overlap them: number groups with any usual separators, names
at hosts with spelled-out signs, dotted and colon-parted addresses. A candidate is
described by its format and the words around it, all in a few classes each.

Trees are boosted on the counts of candidates by such descriptions, over all documents.
A candidate is taken for personal data if a checked base span covers it or if it is
vouched for: named by the words before it, or by two signs of form, check digits and
context. What makes a base span (the plus, the at sign) is hidden from the descriptions,
so candidates without it stand beside checked ones. The table of descriptions is bounded
by the product of the classes, whatever the corpus, so it is fitted on the driver.
Documents with crc32(doc_id) mod 5 = 0 are held out; on them a threshold for each format
is calibrated to a wanted precision. Scores run as SQL ``CASE`` expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.llm.native import let, matches, of_kind, overlaps, span_text, whole
from billweave.staging import staged

#: Kinds in the order of results: base spans, then what the trees add.
KINDS = ("email", "ip", "card", "phone", "number", "address", "host")
# A match starts where the last one ended or not inside a run, so that runs are read once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_SIGN_AT, _SIGN_DOT = r"(?:@|\x20?[(\[]at[)\]]\x20?)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?)"
_GENERATORS = (
    (4, r"(?:\G|(?<![0-9]))[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){8,}+"),
    (5, rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{_SIGN_AT}[A-Za-z0-9-]++(?:{_SIGN_DOT}[A-Za-z0-9-]++)++"),
    (6, r"(?:\G|(?<![0-9a-fA-F:.]))[0-9a-fA-F]{1,4}+(?:[.:][0-9a-fA-F]{1,4}+){3,}+"),
)
_HINTS = r"(?i)(phone|tel|fax|call|mobile|mail|contact|card|visa|account|iban|ssn|address|host|server)"
_AROUND = 24
#: Words right before a candidate that name it, by generator.
_NAMED = {
    kind: rf"(?i)\b(?:{names})\b[\x20:.#=-]{{0,4}}(?:(?:no|nr|number|is|at|to|me|us|address)\b[\x20:.#=-]{{0,4}}){{0,2}}$"
    for kind, names in (
        (4, "phone|telephone|tel|fax|call|mobile|cell|ssn|account"),
        (5, "e-?mail|mail|contact|write|address"),
        (6, "host|server|ip|ipv6|mac|address"),
    )
}
_PARTED = r"[\x20()./-]{1,2}"
_PHONE_FORM = rf"^[+(]*(?:[0-9]{{1,3}}{_PARTED})?[0-9]{{2,4}}{_PARTED}[0-9]{{3}}{_PARTED}[0-9]{{4}}$"
_CARD_FORM = rf"^[0-9]{{4}}(?:(?:{_PARTED}[0-9]{{4}}){{3}}|{_PARTED}[0-9]{{6}}{_PARTED}[0-9]{{5}})$"
_ADDRESS_FORM = rf"^[A-Za-z0-9][A-Za-z0-9._%+-]*{_SIGN_AT}[A-Za-z0-9-]+(?:{_SIGN_DOT}[A-Za-z0-9-]+)*{_SIGN_DOT}[A-Za-z]{{2,24}}$"
_HOST_FORM = r"^(?:[0-9a-fA-F]{2}(?::[0-9a-fA-F]{2}){5}|[0-9a-fA-F]{4}(?:\.[0-9a-fA-F]{4}){2,3}|[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7})$"
HELD_OUT = 5
RATE = 0.4

#: How a candidate is described, without what makes a base span: a name, its number of classes, and the class of (found, before, after).
_FEATURES: tuple[tuple[str, int, Callable[[Column, Column, Column], Column]], ...] = (
    ("digits", 8, lambda f, b, a: _steps(_digits(f), (4, 8, 10, 12, 14, 17, 20))),
    ("groups", 5, lambda f, b, a: _steps(F.size(F.split(F.ltrim(f, F.lit("+(")), r"[^0-9A-Za-z]+", -1)), (2, 3, 5, 7))),
    ("lead", 2, lambda f, b, a: f.startswith("0").cast("int")),
    ("sign", 3, lambda f, b, a: F.when(f.rlike(_SIGN_AT), 1).when(f.contains(":"), 2).otherwise(0)),
    ("form", 5, lambda f, b, a: F.when(f.rlike(_PHONE_FORM), 1).when(f.rlike(_CARD_FORM), 2).when(f.rlike(_ADDRESS_FORM), 3).when(f.rlike(_HOST_FORM), 4).otherwise(0)),
    ("dots", 3, lambda f, b, a: F.when(f.rlike(r"^[^.]*$"), 0).when(f.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), 1).otherwise(2)),
    ("edge", 3, lambda f, b, a: F.when(b.rlike(r"[0-9A-Za-z]$") | a.rlike("^[0-9A-Za-z]"), 1).when(b.rlike(r"[-+./#$]$"), 2).otherwise(0)),
    ("hint", 2, lambda f, b, a: b.rlike(_HINTS).cast("int")),
    ("luhn", 2, lambda f, b, a: luhn(f).cast("int")),
)


def _digits(found: Column) -> Column:
    return F.char_length(F.regexp_replace(found, "[^0-9]", ""))


def _steps(value: Column, bounds: tuple[int, ...]) -> Column:
    result = F.lit(0)
    for i, bound in enumerate(bounds, 1):
        result = F.when(value >= bound, i).otherwise(result)
    return result


def luhn(found: Column) -> Column:
    """The digits pass the Luhn check; the last counts once."""

    def checked(digits: Column) -> Column:
        weighed = F.transform(
            F.split(F.reverse(digits), "", -1),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") / 5).cast("int")
            ),
        )
        return F.when(digits == "", False).otherwise(F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0)

    return let(F.regexp_replace(found, "[^0-9]", ""), checked)


def _small_parts(found: Column) -> Column:
    """All dotted parts are 255 at most."""
    value = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(
        F.split(found, r"\.", -1),
        lambda p: (F.char_length(value(p)) <= 2)
        | ((F.char_length(value(p)) == 3) & (F.lpad(value(p), 3, "0") <= "255")),
    )


def base_spans(text: Column) -> Column:
    number = F.concat(
        of_kind(matches(text, IP), 1, _small_parts),
        of_kind(
            matches(text, CARD), 2,
            lambda m: F.when(_digits(m).between(14, 19), luhn(m)).otherwise(False),
        ),
        of_kind(matches(text, PHONE), 3, lambda m: _digits(m).between(10, 15)),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.concat(
        F.when(whole(text).contains("@"), of_kind(matches(text, EMAIL), 0, lambda m: F.lit(True))).otherwise(none),
        F.when(whole(text).rlike("[0-9]"), number).otherwise(none),
    )


def vouched(kind: int, found: Column, before: Column, after: Column) -> Column:
    """Form, check digits and context say by themselves that a candidate is personal data."""
    alone = ~(before.rlike(r"[0-9A-Za-z]$|[-+./#$]$") | after.rlike("^[0-9A-Za-z]"))
    named, hinted = before.rlike(_NAMED[kind]), before.rlike(_HINTS)
    if kind == 4:
        card = _digits(found).between(13, 19) & luhn(found) & (found.rlike(_CARD_FORM) | hinted)
        phone = _digits(found).between(9, 15) & (named | (found.rlike(_PHONE_FORM) & hinted))
        return alone & (card | phone)
    if kind == 5:
        spelled = found.rlike(r"[(\[]at[)\]]") & found.rlike(r"[(\[]dot[)\]]")
        return alone & found.rlike(_ADDRESS_FORM) & (named | spelled)
    lettered = found.rlike("[a-fA-F]") & found.rlike("[0-9]")
    return alone & found.rlike(_HOST_FORM) & (named | lettered)


def candidates(text: Column) -> Column:
    """(start, kind, end, vouched, classes) of the generators' spans; a class per feature."""

    def described(kind: int, pattern: str) -> Column:
        def of(m: Column) -> Column:
            before = F.substring(text, F.greatest(m["start"] - _AROUND + 1, F.lit(1)), F.least(m["start"], F.lit(_AROUND)))
            after = F.substring(text, m["end"] + 1, F.lit(1))
            before = F.when(m["start"] == 0, "").otherwise(before)
            return F.struct(
                m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
                vouched(kind, m["found"], before, after).alias("vouched"),
                F.array(*[make(m["found"], before, after) for _, _, make in _FEATURES]).alias("classes"),
            )

        return F.transform(matches(text, pattern), of)

    return F.when(
        whole(text).rlike(r"[0-9]|@|[(\[](at|dot)[)\]]"), F.concat(*[described(k, p) for k, p in _GENERATORS])
    ).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,vouched:boolean,classes:array<int>>>"))


@dataclass
class Split:
    """A tree of two questions: is class ``feature`` at most ``bound``, then one more."""

    feature: int
    bound: int
    low: Split | float
    high: Split | float

    def value(self, classes: tuple[int, ...]) -> float:
        side = self.low if classes[self.feature] <= self.bound else self.high
        return side.value(classes) if isinstance(side, Split) else side

    def column(self, classes: Column) -> Column:
        sides = [s.column(classes) if isinstance(s, Split) else F.lit(float(s)) for s in (self.low, self.high)]
        return F.when(F.get(classes, F.lit(self.feature)) <= self.bound, sides[0]).otherwise(sides[1])


Cell = tuple[tuple[int, ...], float, float]  # classes, slope, weight


def _leaf(cells: list[Cell]) -> float:
    return sum(g for _, g, _ in cells) / (sum(h for _, _, h in cells) + 1.0)


def _grown(cells: list[Cell], sizes: list[int], depth: int) -> Split | float:
    def gain(some: list[Cell]) -> float:
        return sum(g for _, g, _ in some) ** 2 / (sum(h for _, _, h in some) + 1.0)

    best, whole_gain = None, gain(cells)
    for feature, classes in enumerate(sizes):
        for bound in range(classes - 1):
            low = [c for c in cells if c[0][feature] <= bound]
            if not low or len(low) == len(cells):
                continue
            high = [c for c in cells if c[0][feature] > bound]
            found = gain(low) + gain(high) - whole_gain
            if best is None or found > best[0] + 1e-12:
                best = (found, feature, bound, low, high)
    if best is None or best[0] < 1e-9:
        return _leaf(cells)
    _, feature, bound, low, high = best
    if depth == 1:
        return Split(feature, bound, _leaf(low), _leaf(high))
    return Split(feature, bound, _grown(low, sizes, depth - 1), _grown(high, sizes, depth - 1))


def boosted(counts: dict[tuple[int, ...], tuple[int, int]], rounds: int = 20) -> list[Split | float]:
    """Trees for the log odds that a candidate is personal data, from (all, positive) counts."""
    sizes = [len(KINDS), *[n for _, n, _ in _FEATURES]]
    odds = dict.fromkeys(counts, 0.0)
    trees: list[Split | float] = []
    for _ in range(rounds if counts else 0):
        cells = []
        for classes, (n, positive) in counts.items():
            p = 1 / (1 + math.exp(-odds[classes]))
            cells.append((classes, positive - n * p, n * p * (1 - p)))
        tree = _grown(cells, sizes, depth=2)
        trees.append(tree)
        for classes in odds:
            odds[classes] += RATE * (tree.value(classes) if isinstance(tree, Split) else tree)
            odds[classes] = max(-30.0, min(30.0, odds[classes]))
    return trees


def _odds(trees: list[Split | float], classes: tuple[int, ...]) -> float:
    total = 0.0
    for t in trees:
        total += RATE * (t.value(classes) if isinstance(t, Split) else t)
    return total


#: Places in (kind, classes) that tell formats apart: generator, signs and form.
_FORMAT = (0, *(i for i, (name, _, _) in enumerate(_FEATURES, 1) if name in ("sign", "form")))


def thresholds(
    trees: list[Split | float], held: dict[tuple[int, ...], tuple[int, int]], precision: float, least: int
) -> dict[tuple[int, ...], float]:
    """For each format the least odds from which held-out candidates reach the precision."""
    found = {}
    of = lambda classes: tuple(classes[i] for i in _FORMAT)
    for kind in {of(c) for c in held}:
        ranked = sorted(((_odds(trees, c), n, p) for c, (n, p) in held.items() if of(c) == kind), reverse=True)
        all_, positive = 0, 0
        for at, (odds, n, p) in enumerate(ranked):
            all_, positive = all_ + n, positive + p
            last = at + 1 == len(ranked) or ranked[at + 1][0] < odds
            if last and positive >= least and positive >= precision * all_:
                found[kind] = odds
    return found


def personal_spans(docs: DataFrame, precision: float = 0.98, least: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans, arrays of (start, kind, end).

    Positions count code points, ends are exclusive; ``kind`` is a place in ``KINDS``.
    ``spans`` are base and the candidates that are vouched for or above their format's
    threshold, that overlap no base span and no reported candidate of higher odds (of equal
    odds: the earlier). NULL and empty texts have none. Repeated rows get equal spans.
    ``precision`` is the share of held-out candidates above the threshold that a checked
    base span covers or that are vouched for; all others count as wrong. Without ``least``
    of the former a format adds only what is vouched for, as that needs no other rows.
    """
    text = whole(F.col("text"))
    scanned = staged(
        docs.select(
            "doc_id",
            F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True)).alias("held"),
            base_spans(text).alias("base"),
            candidates(text).alias("candidates"),
        ),
        "pii-candidates",
    )
    each = scanned.select(
        "held",
        F.explode(F.transform("candidates", lambda c: F.struct(
            F.concat(F.array(c["kind"]), c["classes"]).alias("classes"), (overlaps(c, F.col("base")) | c["vouched"]).alias("personal")
        ))).alias("c"),
    )
    rows = each.groupBy("held", "c.classes").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("c.personal").alias("positive")
    ).collect()
    counts = lambda held: {tuple(r["classes"]): (r["n"], r["positive"]) for r in sorted(rows) if r["held"] == held}
    trees = boosted(counts(False))
    limits = thresholds(trees, counts(True), precision, least)

    def odds(c: Column) -> Column:
        classes = F.concat(F.array(c["kind"]), c["classes"])
        return let(classes, lambda x: sum(
            (F.lit(RATE) * (t.column(x) if isinstance(t, Split) else F.lit(t)) for t in trees), F.lit(0.0)
        ))

    def reported(c: Column) -> Column:
        wanted = F.lit(None).cast("double")
        for format_, value in sorted(limits.items()):
            wanted = F.when(c["format"] == F.array(*map(F.lit, format_)), value - 1e-9).otherwise(wanted)
        return (c["vouched"] | F.coalesce(c["odds"] >= wanted, F.lit(False))) & ~overlaps(c, F.col("base"))

    format_of = lambda c: F.array(c["kind"], *[F.get(c["classes"], F.lit(i - 1)) for i in _FORMAT[1:]])

    scored = F.transform(
        "candidates",
        lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["vouched"].alias("vouched"),
            format_of(c).alias("format"), odds(c).alias("odds"),
        ),
    )
    better = lambda a, b: (a["odds"] > b["odds"]) | (
        (a["odds"] == b["odds"]) & (F.struct(a["start"], a["kind"]) < F.struct(b["start"], b["kind"]))
    )
    alone = let(F.filter(scored, reported), lambda cs: F.filter(
        cs, lambda c: ~F.exists(cs, lambda o: better(o, c) & (o["start"] < c["end"]) & (c["start"] < o["end"]))
    ))
    added = F.transform(alone, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, sorted by start, replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{kind}]") for kind in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"),
        F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))).alias("parts"),
    ))
    return F.aggregate(
        spans, begin, step,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))),
    )


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{KINDS[i]}") for i in range(4)],
        F.sha2(span_text(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans"), KINDS).alias("spans"),
    )

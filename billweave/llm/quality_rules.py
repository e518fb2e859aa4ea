"""Quality rules as a short-circuit cascade.

A rule is a condition on measures of a text. On a bounded sample each rule's cost is
estimated, as the characters and words its measures go through, and the texts it rejects
are noted; rules then run in the order of rejections per cost, each counted on what the
rules before it let through. A ``CASE`` keeps that order for every text and stops at the
first rule that rejects, so a measure that only later rules need is not computed for it.
The order changes the cost, never the verdict.

Cost is counted, not timed, and the sample is chosen by hashes of the texts in a few files
chosen by hashes of their names, so the same table always gives the same order. All work is SQL
expressions on one row; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.llm.native import GAP, WORD, let, lines, numbers, whole, words
from billweave.staging import staged

Measure = Callable[[str], Column]

WINDOW = 8
MIN_WORDS = 20


def _duplicate_lines(text: Column) -> Column:
    worded = F.filter(lines(text), lambda line: line.rlike(WORD))
    return let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long")


def _worded_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda line: line.rlike(WORD))).cast("long")


def _repeat_words(text: Column) -> Column:
    """Words in windows of eight words that are found twice or more in the text.

    Windows are compared by 64-bit hashes of their words' hashes. Only texts in which a
    window comes back sort their windows, so that equal ones stand side by side.
    """

    def hashed(hs: Column) -> Column:
        return F.transform(
            numbers(1, F.size(hs) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hs, i, F.lit(WINDOW)))
        )

    def covered(starts: Column) -> Column:
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, s: F.struct(
            s.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n")
        )
        return F.aggregate(starts, begin, step, lambda acc: acc["n"])

    def repeated(ws: Column) -> Column:
        ordered = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
        )
        starts = let(ordered, lambda s: F.sort_array(F.transform(twice(s), lambda e: e["i"])))
        return F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(covered(starts))

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(let(hashes, hashed), repeated).cast("long")


def _same_as_last(text: Column) -> Column:
    """Words equal to the word before them."""
    return let(
        words(text),
        lambda ws: F.size(F.filter(F.zip_with(ws, F.slice(ws, F.lit(2), F.size(ws)), lambda a, b: a == b), lambda x: x)),
    ).cast("long")


def _left(text: Column, dropped: str) -> Column:
    return F.char_length(F.regexp_replace(whole(text), dropped, "")).cast("long")


#: What rules are made of; each is an expression on the text.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda t: F.size(words(t)).cast("long"),
    "word_chars": lambda t: _left(t, GAP),
    "n_symbols": lambda t: _left(t, r"[^#*$%&|<>]+"),
    "n_lines": _worded_lines,
    "n_dup_lines": _duplicate_lines,
    "n_repeat_words": _repeat_words,
    "n_same_words": _same_as_last,
    "n_capitals": lambda t: _left(t, r"[^A-Z]+"),
    "n_exclamations": lambda t: _left(t, r"[^!]+"),
}


#: What a measure goes through, as an expression on (characters, words): a pass over the text
#: by a pattern, over the words of a split text, or a sort of windows of words.
_WORK: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda c, w: c + w,
    "word_chars": lambda c, w: c,
    "n_symbols": lambda c, w: c,
    "n_lines": lambda c, w: 2 * c,
    "n_dup_lines": lambda c, w: 2 * c,
    "n_repeat_words": lambda c, w: c + 4 * WINDOW * w,
    "n_same_words": lambda c, w: c + 3 * w,
    "n_capitals": lambda c, w: c,
    "n_exclamations": lambda c, w: c,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a measure's name to its column."""

    name: str
    rejects: Callable[[Measure], Column]

    def measures(self) -> set[str]:
        """The names of the measures the rule asks for."""
        asked: set[str] = set()

        def note(name: str) -> Column:
            asked.add(name)
            return F.lit(0)

        self.rejects(note)
        return asked


BASE_RULES = (
    Rule("few_words", lambda m: m("n_words") < MIN_WORDS),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
)
#: Shares far above what plain prose has, whatever its length.
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("capitals", lambda m: 100 * m("n_capitals") > 45 * m("word_chars")),
    Rule("exclamations", lambda m: 2 * m("n_exclamations") > m("n_words")),
    Rule("stutter", lambda m: 100 * m("n_same_words") > 30 * m("n_words")),
    Rule("repeated_lines", lambda m: 100 * m("n_dup_lines") > 60 * m("n_lines")),
)


def _on_text(text: Column) -> Measure:
    return lambda name: MEASURES[name](text)


#: The sample has about so many texts, out of so many files at most.
SAMPLE_ROWS, SAMPLE_FILES = 1000, 8
_SHARES = 1 << 20


def rule_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, files: int = SAMPLE_FILES) -> DataFrame:
    """About ``rows`` texts (text) of ``docs``, the same ones whenever it is called.

    Of a table read from files, ``files`` of them are read; which, the hashes of their names
    say. In them the texts are counted without being read, and hashes of the texts choose.
    Small tables are taken whole. Equal texts are chosen together; NULL counts as empty.
    """
    some = docs.select("text")
    names = sorted(docs.inputFiles(), key=lambda name: hashlib.md5(name.rsplit("/", 1)[-1].encode()).digest())
    if len(names) > files:
        try:
            found = docs.select("text", F.col("_metadata.file_path").alias("_file"))
            some = found.where(F.col("_file").isin([_as_metadata(n) for n in names[:files]])).select("text")
        except AnalysisException:  # not read from files as it is: all of it is sampled
            pass
    share = rows / max(some.count(), 1)
    chosen = some if share >= 1 else some.where(F.pmod(F.xxhash64(whole(F.col("text"))), F.lit(_SHARES)) < int(share * _SHARES))
    return staged(chosen, "rule-sample")


def _as_metadata(name: str) -> str:
    """A file's name as Spark's file metadata has it: not encoded, local ones with one slash."""
    name = unquote(name)
    return "file:/" + name[len("file:") :].lstrip("/") if name.startswith("file:") else name


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per cost on a sample of about ``sample_rows`` texts.

    Rejections are counted anew after each choice, among the texts left. Of equal rules the
    one given first goes first; an empty sample keeps the given order.
    """
    sample = rule_sample(docs, sample_rows)
    text, names = F.col("text"), [r.name for r in rules]
    rejects = [r.rejects(_on_text(text)).alias(r.name) for r in rules]
    seen = [(set(n for n in names if row[n]), row["count"]) for row in sample.select(*rejects).groupBy(*names).count().collect()]
    chars, words_ = F.char_length(whole(text)), F.size(words(text))
    work = lambda r: F.sum(sum((_WORK[m](chars, words_) for m in sorted(r.measures())), F.lit(0))).alias(r.name)
    counted = sample.agg(*[work(r) for r in rules]).first()
    cost = {name: max(counted[name] or 0, 1) for name in names}
    order: list[Rule] = []
    left = list(rules)
    while left:
        taken = {r.name for r in order}
        open_ = [(found, n) for found, n in seen if not found & taken]
        gain = lambda r: sum(n for found, n in open_ if r.name in found) / cost[r.name]  # noqa: E731, B023
        best = max(left, key=gain)
        order.append(best)
        left.remove(best)
    return order


def first_rejection(measure: Measure, order: list[Rule]) -> Column:
    """The first rule of the order that rejects, or NULL; later rules are not evaluated."""
    verdict = None
    for rule in order:
        condition, name = rule.rejects(measure), F.lit(rule.name)
        verdict = F.when(condition, name) if verdict is None else verdict.when(condition, name)
    return F.lit(None).cast("string") if verdict is None else verdict


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns unchanged.

    A NULL or empty text has no words and is rejected by ``few_words``. Repeated rows get
    equal verdicts. Other columns, whatever their names, are passed through.
    """
    order = cascade_order(docs, rules)
    return docs.where(first_rejection(_on_text(F.col("text")), order).isNull())


#: Measures ``verdicts`` reports of every text.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, the reported measures, base_failed, kept.

    The rules that are not base rules run as a cascade, on the texts the base rules let
    through; they use the reported measures, and compute their own where it is their turn. NULL
    and empty texts have no words: all counts are 0 and the text fails the base rules. Very
    long texts are measured whole; repeated rows get equal verdicts; an empty table gives no
    rows.
    """
    text = F.col("text")
    base_names = {rule.name for rule in BASE_RULES}
    order = [rule for rule in cascade_order(docs, rules) if rule.name not in base_names]
    measured = docs.select("doc_id", "text", *[MEASURES[name](text).alias(name) for name in REPORTED])
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.rejects(F.col)
    measure = lambda name: F.col(name) if name in REPORTED else MEASURES[name](text)
    kept = F.when(F.col("base_failed"), False).otherwise(first_rejection(measure, order).isNull())
    return measured.select("doc_id", "text", *REPORTED, base.alias("base_failed")).select(
        "doc_id", *REPORTED, "base_failed", kept.alias("kept")
    )

"""Operators that compare rows: line dedup, mixing, near dedup, containment, audit, repeats, pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from billweave.llm import decontaminate, line_dedup, mixing, near_dedup, suffix_index, warc_audit
from billweave.llm import queries as registered
from billweave.llm.components import components
from tests.llm.messy import empty, messy, prose, texts

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def keys(text: str | None) -> list[str]:
    return [lower(line.strip(SPACES)) for line in (text or "").split("\n")]


@pytest.mark.parametrize("min_docs", [2, 10])
def test_lines_of_many_documents_go(spark, min_docs):
    rows = texts()
    found_in = defaultdict(set)
    for i, t, _ in rows:
        for key in keys(t):
            found_in[key].add((i, t or ""))
    expected = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [line for line, key in zip(lines, keys(t), strict=True) if not key or len(found_in[key]) < min_docs]
        expected.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    df = line_dedup.keep_bitmaps(messy(spark), min_docs)
    got = df.withColumn("t", line_dedup.kept_text(F.col("text"), F.col("_keep"))).collect()
    assert Counter((r.doc_id, r.t, r._lines, r._dropped) for r in got) == Counter(expected)


def test_first_occurrences_stay_on_demand(spark):
    rows = [(i, f"own {i}\nshared\nshared", "s") for i in range(5)]
    df = line_dedup.keep_bitmaps(messy(spark, rows), 2, keep_first=True)
    kept = {r.doc_id: r.t for r in df.withColumn("t", line_dedup.kept_text(F.col("text"), F.col("_keep"))).collect()}
    assert kept == {0: "own 0\nshared", **{i: f"own {i}" for i in range(1, 5)}}


def test_line_stage_keeps_rows_and_columns(spark):
    docs = messy(spark)
    out = line_dedup.without_common_lines(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()
    assert line_dedup.without_common_lines(empty(spark)).count() == 0


def targets_by_hand(sizes: list[int]) -> list[float]:
    """Share by weight; stop what is above; share the rest again."""
    weights, total = [i % 3 + 1 for i in range(len(sizes))], sum(sizes)
    stopped: set[int] = set()
    while True:
        rest = total - sum(3 * sizes[i] for i in stopped)
        free = sum(w for i, w in enumerate(weights) if i not in stopped)
        target = [3 * s if i in stopped else rest * w / free for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
        above = {i for i in range(len(sizes)) if target[i] > 3 * sizes[i]}
        if not above:
            return target
        stopped |= above


@pytest.mark.parametrize("sizes", [[5, 7, 9], [1, 1000, 10, 3], [0, 0, 50], [0, 0], [4]])
def test_targets(spark, sizes):
    rows = [(f"s{i}" if i else None, n, 1) for i, n in enumerate(sizes)]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long, docs long")).collect()
    order = sizes[1:] + sizes[:1]
    got = {r.rank: r.target for r in found}
    assert [got[i + 1] for i in range(len(order))] == pytest.approx(targets_by_hand(order))


def test_mix_meets_targets_and_agrees_with_itself(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    monkeypatch.setattr(mixing, "_GROUP", 3)
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(900)]
    found = mixing.mixed(messy(spark, rows)).collect()
    size, taken = {i: len(t.split()) for i, t, _ in rows}, defaultdict(int)
    for r in found:
        assert r.size == size[r.doc_id] and r.taken == r.copies * r.size and r.copies <= 3
        taken[r.source] += r.taken
    for source, target in {r.source: r.target for r in found}.items():
        assert abs(taken[source] - target) <= 30
    assert 0 <= sum(size.values()) - sum(taken.values()) < 30
    again = mixing.mixed(messy(spark, rows[::-1])).collect()
    assert {r.doc_id: r.taken for r in found} == {r.doc_id: r.taken for r in again}


def test_mix_of_messy_rows(spark):
    assert mixing.mixed(messy(spark)).count() == len(texts())
    assert mixing.mixed(empty(spark)).count() == 0
    wordless = mixing.mixed(messy(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r.target, r.taken) for r in wordless] == [(0, 0), (0, 0)]


def shingles(text: str | None) -> frozenset:
    w = [x for x in lower(text or "").replace("\x0b", " ").replace("\x0c", " ").split() if x] if text else []
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_by_hand(rows: list[tuple]) -> dict:
    sets = defaultdict(set)
    for i, t, _ in rows:
        if i is not None and shingles(t):
            sets[i].add(shingles(t))
    root = {i: i for i, _, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if any(100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}


def test_near_duplicates_of_messy_rows(spark):
    rows = texts()
    expected = components_by_hand(rows)
    found = near_dedup.near_duplicates(messy(spark)).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.n_shingles) for r in found) == Counter((i, len(shingles(t))) for i, t, _ in rows)
    for r in found:
        assert r.component_id == expected.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    docs = messy(spark)
    assert near_dedup.distinct_documents(docs).columns == docs.columns
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_an_id_with_two_texts_links_both(spark):
    a, b, c = prose(61, 40), prose(62, 40), prose(63, 40)
    rows = [(3, b, "s"), (5, a, "s"), (5, b, "s"), (7, a, "s"), (8, c, "s"), (8, a, "s"), (9, c, "s"), (20, prose(64, 40), "s")]
    found = near_dedup.near_duplicates(messy(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(i, 3) for i in (3, 5, 7, 8, 9)} | {(20, 20)}
    assert {r.doc_id: r.component_id for r in found} == components_by_hand(rows)
    assert sorted(r.doc_id for r in near_dedup.distinct_documents(messy(spark, rows)).collect()) == [3, 20]


@pytest.mark.parametrize("group", [2, 200])
def test_chains_and_groups_of_near_copies(spark, group, monkeypatch):
    """Texts that drift apart step by step: only neighbours are similar, all are one component."""
    monkeypatch.setattr(near_dedup, "GROUP", group)
    monkeypatch.setattr(near_dedup, "BLOCK", 3 * group)
    rng, rows = random.Random(11), []
    for g in range(6):
        words = prose(50 + g, 60).split(" ")
        for step in range(25):
            rows.append((1000 * g + rng.randrange(10**6) * 10_000, " ".join(words), "s"))
            at = rng.randrange(len(words))
            words = words[:at] + [f"new{g}x{step}"] + words[at + 1 :]
    rng.shuffle(rows)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(messy(spark, rows)).collect()}
    assert found == components_by_hand(rows)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(50)] + [(900, 900), (-5, 700), (700, -5)]
    random.Random(1).shuffle(edges)
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    expected = {**{i: 0 for i in range(61)}, **{500 + i: 500 for i in range(50)}, -5: -5, 700: -5}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def contained_by_hand(docs: list[tuple], items: list[tuple]) -> Counter:
    found = Counter()
    for i, t, *_ in docs:
        for item, text in items:
            own, whole = shingles(text), shingles(t)
            if own and 100 * len(own & whole) >= 75 * len(own):
                found[i, item, len(own), len(own & whole)] += 1
    return found


@pytest.mark.parametrize("block", [1_000_000, 700])
def test_items_inside_documents(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    rng = random.Random(4)
    items = [(i, prose(700 + i, rng.choice([3, 5, 12, 40, 90]))) for i in range(40)]
    items += [(40, None), (41, ""), (None, prose(900, 30)), (42, items[0][1])]
    docs = texts()
    for i in range(120):
        words, item = prose(3000 + i, rng.choice([20, 400, 3000])).split(" "), rng.choice(items[:40])[1].split(" ")
        at = rng.randrange(len(words))
        part = item[: max(1, round(len(item) * rng.choice([1, 1, 0.85, 0.7])))]
        half = len(part) // 2 if i % 3 == 0 else len(part)
        words = words[:at] + part[:half] + words[at:] + (part[half - 4 :] if half > 4 and half < len(part) else [])
        docs.append((5000 + i, " ".join(words), "s"))
    docs += [(9000, items[0][1], "s"), (9001, prose(900, 30), "s")]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = contained_by_hand(docs, items)
    found = decontaminate.contained_items(messy(spark, docs), table).collect()
    assert Counter((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in found) == expected
    clean = decontaminate.clean_documents(messy(spark, docs), table)
    bad = {i for i, *_ in expected}
    assert sorted(r.doc_id for r in clean.where("doc_id IS NOT NULL").collect()) == sorted(
        i for i, _, _ in docs if i is not None and i not in bad
    )


def test_no_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(messy(spark), none).count() == 0
    assert decontaminate.clean_documents(messy(spark), none).count() == len(texts())
    assert decontaminate.contained_items(empty(spark), none).count() == 0


def test_audit_finds_every_damaged_record(spark):
    rng = random.Random(2)
    rows, offset = [], 0
    for i in range(3000):
        rows.append((rng.choice(["a", "b", None]), offset, rng.randrange(100, 9000), hashlib.sha256(str(i).encode()).hexdigest()))
        offset += rows[-1][2]
    rows += [("a", None, 5, "x"), ("a", None, 5, "x")]
    kind = {i: k for i, k in zip(rng.sample(range(3000), 40), ["changed", "missing", "extra", "longer"] * 10, strict=True)}
    left = [r for i, r in enumerate(rows) if kind.get(i) != "extra"]
    right = [
        (r[0], r[1], r[2] + (kind.get(i) == "longer"), "bad" if kind.get(i) == "changed" else r[3])
        for i, r in enumerate(rows) if kind.get(i) != "missing"
    ]
    schema = "file string, offset long, length long, digest string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    found = {(r.file, r.offset): r.status for r in warc_audit.audit(a, b).collect()}
    name = {"longer": "changed"}
    assert found == {(rows[i][0] or "", rows[i][1]): name.get(k, k) for i, k in kind.items()}
    assert warc_audit.audit(a, a).count() == 0
    none = spark.createDataFrame([], schema)
    assert warc_audit.audit(none, none).count() == 0 and warc_audit.audit(none, a).count() > 2900


def test_layout_of_messy_pages(spark):
    rows = [(1, "http://x", "<p>ñ</p>"), (1, "http://x", "<p>ñ</p>"), (None, None, None), (2, None, ""), (700, "u", "x" * 300_000)]
    found = warc_audit.warc_layout(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 5 and {r.file for r in found if r.page_id is not None} == {"pages-0", "pages-2"}
    first = [r for r in found if r.file == "pages-0"]
    assert sorted(r.offset for r in first) == [0, first[0].length, 2 * first[0].length]


def test_a_file_of_one_id_is_laid_out_in_blocks(spark, monkeypatch):
    """Pages of one id, some of them equal, are not one group; offsets are a running sum in order."""
    monkeypatch.setattr(warc_audit, "_COPIES", 7)
    rows = [(5, f"u{i % 900}", "x" * (i % 900 % 13)) for i in range(1000)] + [(5, "same", "copy")] * 50 + [(900, "u", "")] * 3
    found = warc_audit.warc_layout(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString() and found.count() == len(rows)
    at = dict.fromkeys(["pages-0", "pages-3"], 0)
    for r in sorted(found.collect()):
        assert r.offset == at[r.file]
        at[r.file] += r.length
    blocks = found.sparkSession.createDataFrame([("f", b, 10 * b + 1) for b in range(5)], "file string, block int, size long")
    assert [r.start for r in mixing._block_starts(blocks, ["file"], "block", "size").orderBy("block").collect()] == [0, 1, 12, 33, 64]


def test_roots_of_files_beyond_the_last_level_and_without_offsets(spark):
    """One root for each file, that any record changes; records without offset are not one group."""
    top = warc_audit.RANGE * warc_audit.FAN**warc_audit.LEVELS
    schema = "file string, offset long, length long, digest string"
    rows = [("big", i * top, 9, f"d{i}") for i in range(40)] + [("small", 0, 9, "s"), ("loose", 0, 9, "a")]
    rows += [("loose", None, 5, f"n{i}") for i in range(500)]
    other = [(f, o, n, "bad" if d in ("d33", "n7") else d) for f, o, n, d in rows]
    a, b = (warc_audit.merkle_tree(spark.createDataFrame(r, schema)) for r in (rows, other))
    left, right = ({r.file: r.hash for r in warc_audit.roots(t).collect()} for t in (a, b))
    assert warc_audit.roots(a).count() == 3 and {f for f in left if left[f] == right[f]} == {"small"}
    assert left["small"] == a[-1].where("file = 'small'").first().hash
    assert a[0].where("file = 'loose'").count() > 400
    found = warc_audit.audit(*(spark.createDataFrame(r, schema) for r in (rows, other)), (a, b)).collect()
    assert Counter((r.file, r.offset, r.status) for r in found) == {
        ("big", 33 * top, "changed"): 1, ("loose", -1, "missing"): 1, ("loose", -1, "extra"): 1
    }


def repeats_by_hand(rows: list[tuple], length: int) -> Counter:
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    counts = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    found = Counter()
    for i, b in data:
        marks = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                marks[k : k + length] = b"\1" * length
        spans = sum(m and not (k and marks[k - 1]) for k, m in enumerate(marks))
        found[i, bytes(c for c, m in zip(b, marks, strict=True) if not m), len(b), sum(marks), spans] += 1
    return found


@pytest.mark.parametrize(("length", "prefix", "batches", "class_rows"), [(200, 50, 4, 50_000), (60, 20, 5, 3), (200, 50, 1, 2)])
def test_repeated_bytes(spark, length, prefix, batches, class_rows):
    rng = random.Random(length + batches)
    rows = texts()[:10] + texts()[11:]
    passage = [prose(800 + i, 40) for i in range(4)]
    for i in range(40):
        parts = [prose(4000 + i, rng.randrange(5, 60)), rng.choice(passage), prose(5000 + i, 9)]
        cut = rng.randrange(0, 120)
        rows.append((100 + i, parts[0] + parts[1][cut : rng.randrange(cut, 600)] + parts[2] + ("ab" * 150 if i % 7 == 0 else ""), "s"))
    rows += [(300, "z" * 1000, "s"), (301, "z" * (length + 1), "s"), (302, "y" * length, "s"), (303, "x" * (length - 1), "s")]
    found = suffix_index.without_repeats(messy(spark, rows), length, prefix, batches, class_rows).collect()
    got = Counter((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in found)
    assert got == repeats_by_hand(rows, length)


def test_levels_merge_geometrically(spark):
    levels, rng, seen = suffix_index.SuffixLevels(spark), random.Random(3), Counter()
    for batch in range(7):
        rows = [(rng.randrange(40), rng.randrange(3), 1) for _ in range(20)]
        rows = [(k, 10 * k + n, 1) for k, n, _ in rows]
        found = levels.add(spark.createDataFrame(rows, "kfp long, nfp long, n long")).collect()
        seen.update((k, n) for k, n, _ in rows)
        touched = {k for k, _, _ in rows}
        per = Counter()
        for (k, _), n in seen.items():
            per[k] += n
        assert {(r.kfp, r.nfp): r.n for r in found} == {(k, n): c for (k, n), c in seen.items() if k in touched and per[k] > 1}
        ranks = [rank for rank, *_ in levels.levels]
        assert ranks == sorted(ranks, reverse=True) and len(ranks) <= 4
    levels.close()


def test_no_repeats_in_an_empty_table(spark):
    assert suffix_index.without_repeats(empty(spark)).count() == 0


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in "documents pages benchmark labels".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [*registered.oracle_sql(), "pipeline"])
def test_queries_equal_their_sql(spark, name):
    expected = connection(SF).execute(driver.oracle_sql()[name]).df()
    found = driver.queries()[name](spark, SF).toPandas()
    assert sorted(found.columns) == sorted(expected.columns)
    columns = sorted(expected.columns)
    rows = lambda df: sorted(map(str, df[columns].astype(str).itertuples(index=False, name=None)))
    assert rows(found) == rows(expected)


def test_every_operator_is_registered():
    names = driver.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 11))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_on_messy_rows(spark, folder):
    spark.createDataFrame([(1, prose(900, 30)), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in (texts(), []):
        docs = messy(spark, rows)
        names = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == names
            path = f"{folder}/{id(stage)}-{len(rows)}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= (10 if rows else 0)

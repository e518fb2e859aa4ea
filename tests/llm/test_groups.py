"""Packing, spelling groups and whitening against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from billweave.llm import packing, spelling, whitening
from tests.llm.messy import empty, messy, prose, texts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


# --- packing ---------------------------------------------------------------------------


def plain_ids(text: str | None) -> np.ndarray:
    found = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 2], "<u4")


def check_packed(rows, documents: list[tuple[int | None, str | None]], window: int) -> float:
    """Whether the pieces make up the documents and the sequences; returns the share of padding."""
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id].append((r.start, r.length))
    for doc_id in {i for i, _ in documents}:
        same = [plain_ids(t) for i, t in documents if i == doc_id]
        assert sum(length for _, length in starts[doc_id]) == sum(map(len, same))
        if len(same) == 1:
            at = 0
            for start, length in sorted(starts[doc_id]):
                assert start == at
                crc = zlib.crc32(same[0][start : start + length].tobytes())
                assert pieces[(doc_id, start, length, crc, len(same[0]))] == 1
                at += length
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
        total += at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding / max(total, 1)


def test_ids_of_chunks_are_those_of_the_text():
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as file:
        ids = packing.Ids(file.read())
    awkward = [
        "It's, isn't; THEY'LL go!!! (really?)", "x<|endoftext|>y <|endoftext|>", "a\x1cb\x1fc \x85d\xa0e f　g",
        "İstanbul ΣΊΣΥΦΟΣ J̌ é ́start ﬁne ½ ² 一二三 한국어 \U0001f600‍!", "", " \n\t", "...!?;:,",
        "A.B.C. 12,345.67;", "'s 'S ''s", "end.'s!", "KK ẞ",
    ]
    for text in awkward + [t for _, t, _ in texts() if t]:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(ids.of(text), "<u4")) == expected, text


@pytest.mark.parametrize("window,unit", [(4096, 16), (64, 4)])
def test_pieces_of_awkward_documents(spark, window, unit):
    rows = [*texts(), (900, prose(9, 6000), "long")]
    got = packing.packed(messy(spark, rows), PATH, window=window, unit=unit).collect()
    padding = check_packed(got, [(i, t) for i, t, _ in rows], window)
    assert padding < 0.06
    assert packing.packed(empty(spark), PATH).count() == 0


def test_one_document_needs_no_padding(spark):
    got = packing.packed(messy(spark, [(1, "one two three four five six", "a")]), PATH).collect()
    assert check_packed(got, [(1, "one two three four five six")], 4096) == 0


def test_little_padding_on_the_table(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = driver.queries()["op11_packing"](spark, SF).collect()
    assert check_packed(got, documents, 4096) < 0.006
    cut = sum(n > 1 for n in Counter(r.doc_id for r in got if r.doc_tokens <= 4096).values())
    assert cut < 0.15 * len(documents)


def test_equal_lengths_are_dealt_out(spark):
    """A class with nearly all rows: the ranks in it come from totals of blocks."""
    rows = [(i, prose(5, 100), "a") for i in range(300)]
    got = packing.packed(messy(spark, rows).repartition(7), PATH).collect()
    assert check_packed(got, [(i, t) for i, t, _ in rows], 4096) < 0.03


@pytest.mark.parametrize("seed", range(6))
def test_least_squares_is_optimal(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(12, 30)), rng.normal(size=12)
    if seed % 2:
        a[:, 3] = a[:, 7]  # columns that do the same
    x = packing.nonnegative_least_squares(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and gain.max() < 1e-6 and np.abs(gain[x > 1e-9]).max(initial=0) < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_shelves_are_full_and_take_what_is_there(seed):
    rng = random.Random(seed)
    histogram = [0] + [rng.choice([0, 0, 1, 5, 400]) for _ in range(64)]
    plan = packing.shelves(np.array(histogram))
    used = Counter()
    for shelf in plan:
        assert sum(shelf.classes) == 64 and shelf.repeats > 0
        for c in shelf.classes:
            used[c] += shelf.repeats
    assert all(used[c] <= histogram[c] for c in used)
    places = packing.slots(plan, 64)
    assert all(places[c][-1, 0] == used[c] for c in range(65))
    assert packing.shelves(np.zeros(65)) == []


@pytest.mark.parametrize("documents", [1000, 100_000])
def test_shelves_take_most_of_a_corpus(documents):
    """Lengths as texts have them; how much can be planned hangs on the histogram."""
    lengths = np.minimum(4095, np.random.default_rng(1).lognormal(6.5, 1, documents).astype(int) + 1)
    histogram = np.bincount(-(-lengths // 16), minlength=257)
    planned = sum(sum(shelf.classes) * shelf.repeats for shelf in packing.shelves(histogram))
    assert planned > 0.8 * sum(c * n for c, n in enumerate(histogram))


def test_line_ends_in_powers_of_two():
    line = packing.Line(10, 64 * 3 + 0b101101, 64)
    pieces = [p for at in range(0, line.length, 50) for p in line.pieces(at, min(50, line.length - at))]
    lengths = Counter()
    for sequence, offset, length in pieces:
        assert offset == lengths[sequence]
        lengths[sequence] += length
    assert lengths == {10: 64, 11: 64, 12: 64, 13: 32, 14: 8, 15: 4, 16: 1}


# --- spelling --------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def plain_groups(documents, min_letters: int = 5, min_count: int = 3) -> Counter:
    n = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += len(word) >= min_letters
    n = {w: c for w, c in n.items() if c >= min_count}
    cut = defaultdict(set)
    for w in n:
        for p in range(-1, len(w)):
            cut[w if p < 0 else w[:p] + w[p + 1 :]].add(w)
    near = defaultdict(set)
    for group in cut.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def groups(df, **options) -> Counter:
    found = spelling.spelling_groups(df, **options).collect()
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found)


def test_groups_of_the_table(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = driver.queries()["op12_spelling_groups"](spark, SF).collect()
    assert Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found) == plain_groups(documents)


def test_groups_of_awkward_documents(spark):
    rows = [*texts(), (50, "ÀÉÎÕÜ×÷ àéîõü×÷ ÀÉÎÕÜ× colour COLOUR color Colors " * 9, "a"), (51, "aaaaa aaaaaa aaaaaaa ababab bababa " * 4, "a")]
    rows += [(60, "word" * 5000 + " " + "word" * 5000 + "s " + "word" * 4999 + "wor ", "a")] * 3
    assert groups(messy(spark, rows)) == plain_groups([(i, t) for i, t, _ in rows])
    assert spelling.spelling_groups(empty(spark)).count() == 0


@pytest.mark.parametrize("rare", [0, 2, 32, 10_000])
def test_no_pair_is_lost_at_any_length_of_grams(spark, rare, monkeypatch):
    """Words of few letters, so that grams repeat; with every dictionary from all to nothing."""
    monkeypatch.setattr(spelling, "RARE", rare)
    rng = random.Random(rare)
    made = {"".join(rng.choice("abc") for _ in range(rng.randint(5, 11))) for _ in range(700)}
    for w in list(made)[:300]:
        p, c = rng.randint(0, len(w)), rng.choice("abcd")
        made |= {w[:p] + c + w[p:], w[:p] + c + w[p + 1 :], w[:p] + w[p + 1 :]}
    made = sorted(w for w in made if len(w) >= 5)
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 3) for w in made], "word string, n long")).collect()
    expected = {(a, b) for a in made for b in made if a < b and one_edit(a, b)}
    assert {(r.a, r.b) for r in pairs} == expected and len(pairs) == len(expected)


def test_words_one_edit_apart_share_a_gram():
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(4, 9))) for _ in range(600)}
    shared = Counter(g for w in words for q in range(1, len(w) + 1) for g in ("^" + w[:q], w[-q:] + "$"))
    for rare in (0, 1, 5, 40):
        dictionary = {g for g, n in shared.items() if n > rare}
        lists = Counter(g for w in words for g, cut in spelling.decomposed(w, dictionary) if not cut)
        assert max(lists.values()) <= max(rare, 2)  # a place left open fits two words of two letters
        for w in words:
            p, c = rng.randint(0, len(w)), rng.choice("ab")
            for other in (w[:p] + c + w[p:], w[:p] + c + w[p + 1 :]):
                if other != w and other in words:
                    ours, theirs = (dict(spelling.decomposed(x, dictionary)) for x in (w, other))
                    assert any(g in theirs and not (cut and theirs[g]) for g, cut in ours.items()), (w, other)


def test_forms_are_followed_to_the_last(spark):
    """A chain of ten forms, each twice as frequent as the one before."""
    chain = ["abcdefghijklmno"[: 5 + i] for i in range(10)]
    rows = [(None, " ".join([w] * (3 * 2**i)), "s") for i, w in enumerate(chain)]
    found = {r.word: r for r in spelling.spelling_groups(messy(spark, rows)).collect()}
    assert {r.root for r in found.values()} == {chain[-1]} and found[chain[0]].form == chain[1]


# --- whitening -------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, n string, x int, index int")


def check_whitened(got, rows: list[tuple[int, np.ndarray]], components: int = 32) -> None:
    x = np.floor(64 * np.stack([v for _, v in rows]).astype(np.float64)).astype(np.int64) + 1_000_000
    n, size = x.shape
    apart = n * x - x.sum(0)
    centred = apart / n
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    alive = int((values[:components] > 1e-12 * values[0]).sum())
    expected = centred @ basis[:, :alive] / np.sqrt(values[:alive])
    found = defaultdict(dict)
    for r in got:
        found[r.vec_id][r.component] = r
    assert len(got) == n * min(components, size)
    for k, (vec_id, _) in enumerate(rows):
        for c in range(1, min(components, size) + 1):
            r = found[vec_id][c]
            assert r.n == n and r.deviation == int((apart[k].astype(object) ** 2).sum())
            if c > alive:
                assert r.whitened is None and r.explained == 0
                continue
            assert abs(r.explained - values[c - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-6
            sign = np.sign(sum(found[i][c].whitened * expected[j, c - 1] for j, (i, _) in enumerate(rows)))
            assert abs(r.whitened * sign - expected[k, c - 1]) < 1e-6


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, np.array(r.embedding, np.float32)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(driver.queries()["op13_whitening"](spark, SF).collect(), rows)


def test_whitening_of_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)  # several blocks
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=5).astype(np.float32)) for i in range(40)]
    good = [(i, np.array([*v[:3], 0.5, v[4]], np.float32)) for i, v in good]  # one dimension is constant
    good += [(100 + i, good[0][1]) for i in range(30)]  # many copies
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0] * 4, [1.0] * 6]
    rows = [(i, [float(c) for c in v]) for i, v in good] + [(200 + k, v) for k, v in enumerate(bad)]
    made = vectors(spark, [(i, v, 1, "x", 2, 3) for i, v in rows]).repartition(5)
    check_whitened(whitening.whitened(made).collect(), good)


def test_whitening_without_variance(spark):
    same = vectors(spark, [(i, [1.0, 2.0], 1, "x", 2, 3) for i in (1, 1, None)])
    got = whitening.whitened(same).collect()
    assert len(got) == 6 and all(r.whitened is None and r.deviation == 0 and r.identity_error == 0 for r in got)
    none = vectors(spark, [(1, None, 1, "x", 2, 3)])
    assert whitening.whitened(none).count() == 0 == whitening.whitened(none.limit(0)).count()
    assert whitening.whitened(none).columns == whitening.whitened(same).columns

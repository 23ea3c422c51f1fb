"""Odd inputs of the operators on documents."""

import random

import pytest

from roadpulse.llm import (
    license_scans,
    line_dedup,
    mixing,
    near_dedup,
    quality_rules,
    sentence_pieces,
)
from roadpulse.llm.minimal_hash import MinimalHash


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


# --- quality rules


def _judged(docs):
    book = quality_rules.ledger(docs)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes("v1").alias("kept"),
        "failures",
    )


def test_rules_on_odd_rows(make_docs, same, odd_rows):
    same(_judged(make_docs(odd_rows)), quality_rules.SQL, odd_rows)


def test_rules_on_an_empty_table(make_docs):
    assert _judged(make_docs([])).count() == 0


def test_rejected_go_keeps_columns_and_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = quality_rules.rejected_go(docs)
    assert kept.columns == docs.columns
    good = [i for i, *_, ok, _ in rows(_judged(docs)) if ok]
    assert sorted(r.doc_id for r in kept.collect()) == good


def test_repeated_windows_count_each_word_once(make_docs):
    text = "a b c d e f g h x a b c d e f g h"
    book = quality_rules.ledger(make_docs([(1, text), (2, "a " * 9)])).select("n_repeat_words")
    assert [r[0] for r in book.collect()] == [16, 9]


def test_ablation_and_versions(make_docs):
    quality_rules.POLICIES["length"] = ("few_words",)
    docs = make_docs([(1, "few"), (2, "# " * 5), (3, " ".join(f"w{i}" for i in range(30)))])
    book = quality_rules.ledger(docs)
    assert [r.doc_id for r in book.where(quality_rules.passes("length")).collect()] == [3]
    found = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality_rules.ablations(book, "v1").collect()}
    assert found["few_words"] == (2, 1) and found["symbols"] == (1, 0) and found["long_words"] == (0, 0)
    assert found["short_words"] == (1, 0)


# --- line dedup


def test_lines_on_odd_rows(make_docs, same, odd_rows):
    docs = make_docs(odd_rows)
    done = line_dedup._deduped(docs).selectExpr(
        "row.doc_id as doc_id", "size(split(text, '\\n', -1)) n_lines",
        "greatest(size(drops), 0) n_dropped", "sha2(kept, 256) kept_sha256",
    )
    same(done, line_dedup.SQL, odd_rows)


def test_lines_of_an_empty_table(make_docs):
    assert line_dedup.without_repeated_lines(make_docs([])).count() == 0


def test_lines_keep_columns_and_follow_with_n_chars(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert [r.text for r in out.where("doc_id = 5").collect()] == [odd_rows[4][1]]
    assert [r.text for r in out.where("doc_id = 7").collect()] == ["repeated row"] * 2


def test_many_shards_and_heads(make_docs, same, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 7)
    monkeypatch.setattr(line_dedup, "HEADS", 20)
    some = random.Random(1)
    texts = [(i, "\n".join(f"a line numbered {some.randint(0, 60) ** 2}" for _ in range(9))) for i in range(90)]
    texts = [(i, f"in every document\n{t}") for i, t in texts]
    done = line_dedup._deduped(make_docs(texts)).selectExpr(
        "row.doc_id as doc_id", "size(split(text, '\\n', -1)) n_lines",
        "greatest(size(drops), 0) n_dropped", "sha2(kept, 256) kept_sha256",
    )
    same(done, line_dedup.SQL, texts)


def test_minimal_hash_numbers_every_key_once():
    import numpy as np

    a, b = np.random.default_rng(1).integers(0, 2**63, (2, 5000), np.uint64)
    numbers = MinimalHash.build(a, b)
    assert sorted(numbers.find(a, b)) == list(range(5000))
    assert len(numbers.bits) * 64 < 4 * 5000 * 1.5
    empty = MinimalHash.build(a[:0], b[:0])
    assert (empty.find(a[:3], b[:3]) == -1).all()


# --- near-duplicates


def _plain_components(texts):
    """(doc_id, n, component) by comparing all pairs."""
    def items(t):
        w = (t or "").encode().lower().split()
        return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)

    sets, parent = [items(t) for _, t, *_ in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    ids = [near_dedup.LAST_ID if i is None else i for i, *_ in texts]
    least = {}
    for k, i in enumerate(ids):
        least[root(k)] = min(i, least.get(root(k), i))
    return sorted((ids[k], len(sets[k]), least[root(k)]) for k in range(len(texts)))


def _near_rows(docs):
    return sorted((r.doc, r.n_shingles, r.component) for r in near_dedup.memberships(docs).collect())


def test_near_duplicates_on_odd_rows(make_docs, odd_rows):
    assert _near_rows(make_docs(odd_rows)) == _plain_components(odd_rows)


@pytest.mark.parametrize("small, queries", [(24, 256), (2, 3)])
def test_near_duplicates_in_large_groups(make_docs, monkeypatch, small, queries):
    """Chains and hubs around the threshold, through small buckets, pivots and blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "QUERIES", queries)
    some = random.Random(small)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for i in range(160):
        words = base.copy()
        for _ in range(some.choice([0, 1, 3, 5, 8, 12])):
            words[some.randrange(100)] = f"x{some.randrange(500)}"
        texts.append((i, " ".join(words)))
    assert _near_rows(make_docs(texts)) == _plain_components(texts)


def test_a_likely_pair_that_fails_holds_no_link_back(make_docs, monkeypatch):
    """q differs in fewer bits from c1 (similarity 0.75) than from c2 (0.82), and c1 and c2 are linked."""
    import numpy as np

    monkeypatch.setattr(near_dedup, "SAMPLE", 1024)
    c2 = [f"a{i}" for i in range(1641)]
    q = [*c2, *(f"s{i}" for i in range(75)), *(f"q{i}" for i in range(285))]
    c1 = [*c2, *(f"s{i}" for i in range(75)), *(f"c{i}" for i in range(286))]
    texts = [(i, " ".join(words)) for i, words in enumerate((q, c1, c2))]
    docs = make_docs(texts)
    made = sorted(near_dedup.features(docs).collect(), key=lambda r: r.doc)
    sketches = [np.frombuffer(r.sketch, np.uint64) for r in made]
    bits = [int(np.bitwise_count(sketches[0] ^ x).sum()) for x in sketches[1:]]
    assert bits[0] < bits[1] < 0.75 * near_dedup.limit(2000, 1640)

    # One band, in which the three meet; the pivots leave q to the blocks.
    band = next(b for b, keys in enumerate(zip(*(r.bands for r in made))) if len(set(keys)) == 1)
    part = slice(band * near_dedup.ROWS, (band + 1) * near_dedup.ROWS)
    for name in ("_FACTORS", "_SHIFTS"):
        monkeypatch.setattr(near_dedup, name, getattr(near_dedup, name)[part])
    monkeypatch.setattr(near_dedup, "BANDS", 1)
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    pivots = near_dedup._with_pivots
    monkeypatch.setattr(near_dedup, "_with_pivots", lambda m: pivots(m).where("n_a <> 2000 and n_b <> 2000"))
    assert _plain_components(texts) == [(0, 2000, 0), (1, 2001, 0), (2, 1640, 0)]
    assert _near_rows(docs) == _plain_components(texts)


def test_width_of_shingles(make_docs):
    """25 words changed over 500: similarity 0.82 on word pairs, 0.6 on five words."""
    base = [f"b{i}" for i in range(500)]
    edited = [f"x{i}" if i % 20 == 10 else w for i, w in enumerate(base)]
    docs = make_docs([(1, " ".join(base)), (2, " ".join(edited)), (3, "three words only"), (4, "Three words only")])
    counts = {w: sorted((r.doc, r.n_shingles, r.component) for r in near_dedup.memberships(docs, w).collect()) for w in (2, 5)}
    assert counts[2] == [(1, 499, 1), (2, 499, 1), (3, 2, 3), (4, 2, 3)]
    assert counts[5] == [(1, 496, 1), (2, 496, 2), (3, 1, 3), (4, 1, 3)]
    assert sorted(r.doc_id for r in near_dedup.one_of_each(docs, 5).collect()) == [1, 2, 3]


def test_one_of_each_keeps_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 8 in ids and 9 not in ids and ids.count(7) == 1 and None in ids
    assert near_dedup.one_of_each(make_docs([])).count() == 0


def test_sketches_never_reject_a_link():
    import numpy as np

    draw = np.random.default_rng(5)
    for n in (5, 50, 300, 5000, 40_000):
        items = np.unique(draw.integers(0, 2**63, int(n * 1.4), np.uint64))[:n]
        share = max(1, n // 10)
        x, y = np.sort(draw.permutation(items)[share:]), np.sort(draw.permutation(items)[share:])
        both = len(np.intersect1d(x, y))
        a, b = (np.frombuffer(near_dedup.odd_sketch(s), np.uint64)[None] for s in (x, y))
        width = min(a.shape[1], b.shape[1])
        bits = np.bitwise_count(near_dedup.folded(a, width) ^ near_dedup.folded(b, width)).sum()
        if 100 * both >= 80 * (len(x) + len(y) - both):
            assert bits <= near_dedup.limit(len(x), len(y))


# --- mixing


def test_mix_on_odd_rows(make_docs, same, odd_rows):
    same(mixing.copies(make_docs(odd_rows)), mixing.SQL, odd_rows)


def test_mix_of_empty_tables(make_docs):
    assert mixing.copies(make_docs([])).count() == 0
    assert [r.taken for r in mixing.copies(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_mix_hits_targets_and_repeats_itself(make_docs, same, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    some = random.Random(2)
    texts = [(i, "w " * some.randint(0, 40), some.choice(["a"] * 6 + ["b", "c", None])) for i in range(900)]
    docs = make_docs(texts)
    first = mixing.copies(docs)
    same(first, mixing.SQL, texts)
    assert rows(mixing.copies(docs.repartition(7))) == rows(first)
    for r in first.groupBy("source_size", "target").sum("taken").collect():
        assert abs(r["sum(taken)"] - r["target"]) <= 40
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.copies for r in first.collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in taken.items() for _ in range(n))


# --- licences


def test_licences_on_odd_rows(make_docs, same, odd_rows):
    texts = [*odd_rows, (20, license_scans.TEMPLATES["MIT"]), (21, "released under the mit license"),
             (22, "x\n\n" + license_scans.TEMPLATES["ISC"] + "\n\ny"), (23, "Released under the MIT licence?")]
    docs = make_docs(texts)
    summary = license_scans.matches(docs).selectExpr(
        "doc_id", "n_units", "cast(size(matches) as long) n_matches",
        "get(matches, 0).license license", "round(get(matches, 0).dice, 6) dice",
    )
    same(summary, license_scans.SQL, texts)
    best = {r.doc_id: r.matches for r in license_scans.matches(make_docs(texts)).collect()}
    assert best[1] == [] and best[4] == []
    assert best[20][0].license == "MIT" and best[20][0].dice == 1.0
    assert [m.license for m in best[21]] == ["MIT (name)"]
    assert best[22][0].license == "ISC"
    # As a line 3 of 4 bigrams in common, 0.75; its first four words as a passage more.
    assert [(m.license, round(m.dice, 3)) for m in best[23]] == [("MIT (name)", 0.857)]
    assert license_scans.matches(make_docs([])).count() == 0


def _laid_out(name):
    """A template with a blank line after every third line."""
    lines = [line.strip() for line in license_scans.TEMPLATES[name].split("\n")]
    return "\n\n".join("\n".join(lines[i : i + 3]) for i in range(0, len(lines), 3))


def test_licences_inside_larger_documents(make_docs):
    """Several paragraphs followed by code, and a sentence in mid-line."""
    code = "\n\n".join(f"def f{i}(a, b):\n    return a + b * {i}" for i in range(60))
    names = ["MIT", "Apache-2.0 (notice)", "GPL-3.0 (notice)", "BSD-2-Clause"]
    texts = [(i, f"{code}\n\n{_laid_out(name)}\n\n{code}") for i, name in enumerate(names)]
    prose = "some words of prose "
    texts += [(10, f"{prose * 9}released under the MIT License {prose * 9}"), (11, f"{code}\n{prose * 99}"),
              (12, f"{code}\nReleased under the MIT licence?\n{code}")]
    found = {r.doc_id: r.matches for r in license_scans.matches(make_docs(texts)).collect()}
    for i, name in enumerate(names):
        assert (name, 1.0) in [(m.license, m.dice) for m in found[i]]  # and what the notice names
    assert [(m.license, m.dice) for m in found[10]] == [("MIT (name)", 1.0)]
    assert found[11] == []
    assert [(m.license, round(m.dice, 3)) for m in found[12]] == [("MIT (name)", 0.857)]


def test_passages_are_the_best_of_all_runs(make_docs):
    """Against every run of words, on a template with repeats and texts of its words."""
    template = "a b c a b d e f"
    known, some = set(license_scans.bigrams(template)), random.Random(6)
    span = license_scans.sizes(len(known), 0.8)[1] + 7 - len(known)
    texts = []
    for i in range(150):
        words = template.split()
        for _ in range(some.choice([0, 1, 1, 2])):
            words[some.randrange(8)] = some.choice("abxy")
        around = [[some.choice("abcdexyz") for _ in range(some.randint(12, 20))] for _ in range(2)]
        words = around[0] + words + around[1]
        texts.append((i, " ".join(words)))
    found = license_scans.matches(make_docs(texts), {"t": template})
    got = {r.doc_id: [round(m.dice, 9) for m in r.matches] for r in found.collect()}
    for i, text in texts:
        w = text.split()
        pairs = [f"{a} {b}" for a, b in zip(w, w[1:])]
        runs = [set(pairs[a:b]) for a in range(len(pairs)) for b in range(a + 1, min(a + span, len(pairs)) + 1)]
        best = max(2 * len(r & known) / (len(r) + len(known)) for r in runs)
        assert got[i] == ([round(best, 9)] if best >= 0.8 else []), text
    assert 20 < sum(map(bool, got.values())) < 150


def test_sizes_bound_the_coefficient():
    for n in (3, 10, 170):
        low, high = license_scans.sizes(n, 0.8)
        assert 2 * low >= 0.8 * (low + n) and 2 * (low - 1) < 0.8 * (low - 1 + n)
        assert 2 * n >= 0.8 * (high + n) and 2 * n < 0.8 * (high + 1 + n)


# --- SentencePiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


def test_pieces_on_odd_rows(make_docs, library, odd_rows):
    from hashlib import sha256

    got = rows(sentence_pieces.digests(make_docs(odd_rows)))
    want = []
    for i, text, *_ in odd_rows:
        ids = library.encode(text or "")
        joined = ",".join(map(str, ids))
        digests = [sha256(t.encode()).hexdigest() for t in (joined, library.decode(ids))]
        want.append((i, len(ids), *digests))
    assert got == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_encoded_and_decoded_columns(make_docs, library, odd_rows):
    docs = make_docs(odd_rows)
    out = sentence_pieces.encoded(docs)
    assert set(out.columns) == set(docs.columns)
    back = sentence_pieces.decoded(out)
    for r in back.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    assert sentence_pieces.encoded(make_docs([])).count() == 0


def test_pieces_on_random_texts(library):
    own = sentence_pieces.encoder(sentence_pieces.default_model())
    some = random.Random(4)
    parts = ["prod", "in", "men", "er", "ment", "tion", "a", "aa", "\n", " ", "  ", "▁", "é", "漢", "🙂", "\x00", "St"]
    texts = ["".join(some.choice(parts) for _ in range(some.randint(0, 90))) for _ in range(600)]
    texts += [" " * n + x for n in (1, 15, 16, 17, 48, 100) for x in ("", "a", "漢")]
    assert own.encode(texts) == [library.encode(t) for t in texts]


def test_long_texts_are_cut_at_words(library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CHUNK", 50)
    own = sentence_pieces.Encoder(sentence_pieces.Pieces(sentence_pieces.default_model()))
    text = "Some words  and   spaces, " * 40 + "x" * 300 + " end"
    assert own.encode([text]) == [library.encode(text)]
    assert own.digests([text])[0][0] == len(library.encode(text))


# --- rows alike


def test_mix_of_many_null_ids_meets_its_target(make_docs, same):
    rows = [(None, "w " * 50, "a")] * 1_000 + [(i, "x y", "b") for i in range(300)] + [(7, "x y z", "c")] * 400
    docs = make_docs(rows).repartition(5)
    got = mixing.copies(docs).drop("copies")
    same(got, mixing.SQL, rows)
    sums = {(r.source_size, round(r.target)): r.t for r in got.groupBy("source_size", "target").agg({"taken": "sum"})
            .withColumnRenamed("sum(taken)", "t").collect()}
    assert len(sums) == 3 and all(abs(taken - target) <= 51 for (_, target), taken in sums.items())
    taken = mixing.mixed(docs).groupBy("source").count().collect()
    words = {"a": 50, "b": 2, "c": 3}
    assert sorted(r["count"] * words[r.source] for r in taken) == sorted(sums.values())


def test_one_of_each_keeps_one_of_repeated_rows(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, text), (1, text), (2, text), (3, "other words here"), (3, "other words here"), (4, None), (4, None)])
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_members_of_a_large_bucket_meet_its_pivots_in_parts(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "MEMBERS", 3)
    random.seed(4)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base[:i % 7] + ["z"] + base[i % 7 + 1 :] + [f"e{i}"]) for i in range(60)]
    docs = make_docs(list(enumerate(texts)))
    pairs = [set(zip(t.split(), t.split()[1:])) for t in texts]
    parent = list(range(60))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(60):
        for j in range(i):
            if 100 * len(pairs[i] & pairs[j]) >= 80 * len(pairs[i] | pairs[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    found = near_dedup.memberships(docs).collect()
    assert {r.doc: r.component for r in found} == {i: root(i) for i in range(60)}


def test_lines_are_staged_once(make_docs, monkeypatch):
    """Every staged table is one more file per task; heads and arrays go on without."""
    labels, staged = [], line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, label: labels.append(label) or staged(df, label))
    out = line_dedup.without_repeated_lines(make_docs([(1, "one common line\na"), (2, "One common line\nb")]))
    assert sorted(out.select("doc_id", "text").collect()) == [(1, "one common line\na"), (2, "b")]
    assert labels == ["lines"]


def test_sketches_are_compared_in_one_python_step(spark):
    """Each Python step of a stage keeps a worker of its own per core."""
    pairs = spark.createDataFrame([(1, 9, 2, 9), (1, 9, 3, 9)], "a long, n_a long, b long, n_b long")
    sketches = [(1, bytes(32)), (2, b"\x03" + bytes(31)), (3, b"\x07" + bytes(31))]
    reps = spark.createDataFrame(sketches, "cls long, sketch binary")
    passing = near_dedup._passing(pairs, reps)
    assert passing._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in passing.collect()] == [(1, 2, 2, 2.0)]

"""Operators across documents against brute force, on awkward tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlark.llm import components, line_dedup, mixing, near_dup, suffix_dedup
from llm_brute import SPACED, awkward_texts, benchmark_hits, near_groups, prose, quality_counts, removed_bytes, sha256, shingle_set, without_runs

CLASH = "rid long, row long, key string, mark long, spans string, node long, comp long, n long, size long, lines string, c0 string, n_lines int"


def clashing(spark, rows, schema="doc_id long, text string"):
    """Rows with further columns named like those the operators use inside."""
    extra = [1, 2, "k", 3, "s", 4, 5, 6, 7, "l", "c", 8]
    return spark.createDataFrame([(*row, *extra) for row in rows], f"{schema}, {CLASH}")


def text_key(doc_id, text) -> tuple:
    return str(doc_id), text or ""


@pytest.mark.parametrize("bucket_bytes", [2 << 20, 3000])
def test_repeated_bytes(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    rows = awkward_texts()
    found = suffix_dedup.remove_repeats(clashing(spark, rows).repartition(3))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), sha256(bytes(r.kept))) for r in found.collect())
    want = sorted((str(i), n, gone, spans, sha256(kept)) for (i, _), (n, gone, spans, kept) in
                  zip(rows, removed_bytes([t for _, t in rows])))
    assert got == want
    assert any(gone for _, _, gone, _, _ in want)


def test_repeated_bytes_under_one_frequent_key(spark, monkeypatch):
    """A passage that half of all texts share, so its edges are one very frequent key."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    passage = prose(7, 80)
    rows = [(i, f"{prose(100 + i, 20)} {passage} {prose(500 + i, 20)}") for i in range(80)]
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, _), (n, gone, spans, kept) in zip(rows, removed_bytes([t for _, t in rows])):
        assert (found[i].n_bytes, bytes(found[i].kept), len(found[i].spans)) == (n, kept, spans)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    rows = awkward_texts()
    got = near_dup.groups(clashing(spark, rows).repartition(3), shingle=size).collect()
    sets = {text_key(i, t): shingle_set(t, size) for i, t in rows}
    assert len(got) == len(rows)
    want = near_groups([t for _, t in rows], size)
    ids = [i for i, _ in rows]
    smallest = sorted((str(ids[k]), len(sets[text_key(*rows[k])]), str(min((ids[j] for j in group if ids[j] is not None), default=None)))
                      for group in want for k in group if sets[text_key(*rows[k])])
    assert sorted((str(r.doc_id), r.n, str(r.first_id)) for r in got if r.n) == smallest
    assert any(len(group) > 3 for group in want)


def test_groups_that_no_head_holds_together(spark):
    """Chains of copies, each like the next one only."""
    words = prose(9, 200, 5000).split(" ")
    rows = []
    for i in range(40):
        words = words[:i * 5] + [f"n{i}"] * 3 + words[i * 5 + 3:]
        rows.append((i, " ".join(words)))
    got = near_dup.groups(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    want = near_groups([t for _, t in rows], 2)
    assert len({r.component for r in got}) == len(want)
    for group in want:
        assert {r.first_id for r in got if r.doc_id in group} == {min(group)}


def test_meeting_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MEET", 3)
    test_groups_that_no_head_holds_together(spark)


def test_kept_rows(spark):
    rows = awkward_texts()
    docs = clashing(spark, rows)
    kept = near_dup.keep_one(docs, shingle=2)
    assert kept.columns == docs.columns
    sets = [shingle_set(t, 2) for _, t in rows]
    assert kept.count() == sum(1 for group in near_groups([t for _, t in rows], 2))
    assert kept.where("text is null or trim(text) = ''").count() >= sum(t in (None, "") for _, t in rows)
    assert any(sets)
    assert near_dup.keep_one(docs.limit(0)).count() == 0


def test_sketches_bound_the_difference(spark):
    rows = [(i, prose(70 + i % 2, 300 + 40 * i, 3000)) for i in range(12)]
    made = near_dup.sketch(near_dup._marked(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"), 2).toArrow()
    made = made.combine_chunks().sort_by("doc_id")
    parity, n = made["parity"].combine_chunks(), made["n"].to_numpy()
    sets = [shingle_set(t, 2) for _, t in rows]
    import numpy as np
    i, j = np.triu_indices(12, 1)
    bits = near_dup.differing(parity, parity, i, j, n[i], n[j])
    assert (n == [len(s) for s in sets]).all()
    assert all(b <= len(sets[x] ^ sets[y]) for b, x, y in zip(bits, i, j))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 200), (200, 100), (300, 300)]
    got = {}
    for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect():
        got.setdefault(r.comp, set()).add(r.node)
    assert all(comp in nodes for comp, nodes in got.items())
    assert sorted(map(sorted, got.values())) == [list(range(k, k + 20)) for k in (0, 20, 40)] + [[100, 200]]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_runs(spark):
    lines = [f"line {i} {prose(i, 5)}" for i in range(30)]
    rows = [(1, "\n".join(lines[:10])), (2, "\n".join(["own", *lines[3:8], "end"])), (3, "\n".join(lines[8:12])),
            (4, "\n".join(lines[:2] * 4)), (5, None), (6, ""), (7, "\n\n\n\n\n"), (8, "\n\n\n\n\n"), (9, "\n".join(lines[:10])),
            (None, "\n".join(lines[:10])), (10, "x\n\ny\n\nx\n\ny\n\nz"), (11, "\n".join(lines[20:23]) + "\n"), (12, "\n".join(lines[20:23])),
            (13, "\n".join(f"l{i}" for i in range(5000))), (14, "\n".join(f"l{i}" for i in range(4990, 5000)))]
    docs = clashing(spark, rows).drop("n_lines")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs.repartition(3)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    want = without_runs(order)
    for i, text in rows:
        gone = want[i, text]
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        runs = sum(k - 1 not in gone for k in gone)
        assert (got[i].n_lines, got[i].n_removed, got[i].n_runs, got[i].text) == (
            0 if text is None else text.count("\n") + 1, len(gone), runs, kept), i
    assert want[2, rows[1][1]] and want[9, rows[8][1]]
    left = line_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, t in rows if t is None or len(want[i, t]) < t.count("\n") + 1}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_long_passages_of_few_lines(spark):
    one, half, other, wide = prose(1, 60), prose(2, 30), prose(3, 30), "日本語" * 150
    rows = [(1, f"head\n{one}\nend"), (2, f"{one}\nown"), (3, f"a\n{half}\n{other}\nb"), (4, f"{half}\n{other}"),
            (5, f"c\n{half}\nd"), (6, "few words"), (7, "few words"), (8, f"few words\nx\n{wide}"), (9, wide), (10, " "), (11, " "),
            (None, one), (12, f"x\n{half}\n{other}\n{one}\ny"), (13, "few words\nx\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_dedup.without_repeats(docs.repartition(3)).collect()}
    gone = {2: "own", 4: None, 7: None, 9: None, None: None, 12: "x\ny"}
    assert left == {i: gone.get(i, text) for i, text in rows if gone.get(i, text) is not None}
    counts = {r.doc_id: (r.n_removed, r.n_runs) for r in line_dedup.dedup_lines(docs, short_words=50).collect()}
    assert counts[4] == (2, 1) and counts[12] == (3, 1) and counts[5] == (0, 0)
    assert all(r.n_removed == 0 for r in line_dedup.dedup_lines(docs).collect())


def test_repeated_rows_lose_the_same_lines(spark):
    text = "\n".join(f"line {i}" for i in range(6))
    rows = [(1, text), (1, text), (2, text), (2, text)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 6), (2, 6)]


def wanted_targets(sizes: dict) -> dict:
    """Targets by sharing and resharing, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, live = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and live:
        total = sum(weight[s] for s in live)
        for s in live:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in live)
        for s in [s for s in live if target[s] >= 2 * sizes[s]]:
            target[s] = 2.0 * sizes[s]
            live.discard(s)
    return target


@pytest.mark.parametrize("block_words", [1024, 16])
def test_mixture(spark, block_words, monkeypatch):
    monkeypatch.setattr(mixing.mix, "__defaults__", (block_words,))
    rows = [(i, prose(i, 20 + i % 50), f"s{i % 3 if i % 2 else 0}") for i in range(300)]
    rows += [(400, None, "s1"), (401, "", None), (402, prose(3, 40), None), (None, prose(4, 30), "tiny"), (403, "one", "Z"), (403, "one", "Z"),
             (404, prose(5, 3000), "s2"), (405, "", "none")]
    docs = clashing(spark, rows, "doc_id long, text string, source string").drop("size")
    got = mixing.mixed(docs.repartition(3)).collect()
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(SPACED.findall(text or ""))
    want = wanted_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))


def test_schedule_is_even(spark):
    """Every stretch of the schedule holds the sources nearly in proportion; pieces fill each slot."""
    rows = [(i, prose(i, 100), "a" if i % 3 else "b") for i in range(200)]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    goals = mixing.targets(sizes)
    slots = sorted((r.slot, r.key, r.k) for r in mixing.schedule(goals, 64).collect())
    goal = {r.key: r.target for r in goals.collect()}
    for begin in range(0, len(slots) - 50, 37):
        share = sum(key == "+a" for _, key, _ in slots[begin:begin + 50]) / 50
        assert abs(share - goal["+a"] / sum(goal.values())) < 0.08
    for key in goal:
        assert [k for _, s, k in slots if s == key] == list(range(sum(s == key for _, s, _ in slots)))
    pieces = mixing.mix(sizes, goals, 64).groupBy("slot").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    words = [r.words for r in pieces.collect()]
    assert len(words) == len(slots) and max(words) - min(words) <= 3


def test_empty_mixture(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixed(docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mixed(blank).collect()} == {(0.0, 0)}


def corpus() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with something for every stage to do."""
    passage = prose(2, 60, 12)
    rows = [(i, "\n".join(prose(i * 50 + k, 15, 12) for k in range(6)), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[5][1], "en", "s0"), (101, None, "en", "s1"), (102, "# | " * 100, "en", "s1"), (103, "short", "en", "s2"),
             (104, rows[7][1].replace("w1 ", "zz ", 2), "en", "s2"), (105, prose(900, 40, 12) + " " + passage, "en", None),
             (106, "new head\n" + "\n".join(rows[9][1].split("\n")[1:5]) + "\n" + prose(77, 30, 12), "en", "s1")]
    return [(*row, len(row[1] or "")) for row in rows]


def test_pipeline(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark.createDataFrame(corpus(), schema).write.parquet(f"{folder}/documents.parquet")
    items = [("a", prose(2, 60, 12))]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        before, after = {r.doc_id: r.text for r in docs.collect()}, out.collect()
        seen.append((before, after))
        if i < len(corpus_pipeline.STAGES) - 1:
            path = f"{folder}/stage{i}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    good = {r.doc_id for r in seen[0][1]}
    assert good == {i for i, t in seen[0][0].items() if quality_counts(t)[0] >= 10 and i != 102}
    lines = {r.doc_id: r.text for r in seen[1][1]}
    gone = without_runs(sorted(seen[1][0].items()))
    for i, text in seen[1][0].items():
        kept = [x for k, x in enumerate(text.split("\n")) if k not in gone[i, text]]
        assert lines.get(i, "") == "\n".join(kept)
    assert all(r.n_chars == len(r.text) for r in seen[1][1])
    texts = list(seen[2][0].items())
    groups = near_groups([t for _, t in texts], near_dup.SHINGLE)
    assert {r.doc_id for r in seen[2][1]} == {min(texts[k][0] for k in group) for group in groups}
    clean = {i for (i, t), hit in zip(seen[3][0].items(), benchmark_hits(list(seen[3][0].values()), items)) if not hit[1]}
    assert {r.doc_id for r in seen[3][1]} == clean and 105 not in clean
    assert {r.doc_id for r in seen[4][1]} == clean
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, whole)) == sorted(map(str, seen[4][1]))

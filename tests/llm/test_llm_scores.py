"""The language model against a plain version, and its seating against exact distributions."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import pitman_yor
from ledgerlark.llm.blocks import blocks, mix
from llm_brute import LOWER, SPACED, awkward_texts, prose

CLASH = "unit long, bucket int, data string, held boolean, sums0 int"


def fold_is_held(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def tokens_of(text) -> list:
    return [*SPACED.findall((text or "").translate(LOWER)), None]


def base_rows(rows) -> list[tuple]:
    train = Counter(t for i, text in rows if not fold_is_held(i) for t in tokens_of(text))
    total, types = sum(train.values()), len(train)
    return [(i, fold_is_held(i), len(tokens_of(text)), sum(train[t] > 0 for t in tokens_of(text)), total,
             sum(math.log10((train[t] + 0.1) / (total + 0.1 * (types + 1))) for t in tokens_of(text))) for i, text in rows]


def word_hash(word) -> np.uint64:
    if word is None:
        return pitman_yor.END
    return pitman_yor._tokens(next(blocks(pa.array([word]))))[0][0]


class Plain:
    """The model restaurant by restaurant."""

    def __init__(self, rows, sweeps=pitman_yor.SWEEPS, burn_in=pitman_yor.BURN_IN):
        self.c, self.train = Counter(), Counter()
        for i, text in rows:
            if not fold_is_held(i):
                tokens = tokens_of(text)
                self.train.update(tokens)
                self.c.update(zip(["<start>", *tokens], tokens))
        self.d = self.discount(self.c.values())
        self.samples, seats = [], dict.fromkeys(self.c, 1)
        hashes = {w: word_hash(w) for w in self.train} | {"<start>": pitman_yor.START}
        for sweep in range(sweeps + 1):
            if sweep:
                below, above, total = self.samples[-1][1:]
                fresh = {}
                for (u, w), c in self.c.items():
                    own = seats[u, w]
                    chance = (max(above[w] - own, 1) - self.d0) / (1 + total)
                    key = mix(mix(np.array([hashes[u]])) + hashes[w])
                    base = (1 + self.d * (below[u] - own)) * chance
                    fresh[u, w] = int(pitman_yor.tables(np.array([c]), np.array([base]), np.array([self.d * chance]), self.d, key, sweep)[0])
                seats = fresh
            below, above = Counter(), Counter()
            for (u, w), t in seats.items():
                below[u] += t
                above[w] += t
            if not sweep:
                self.d0 = self.discount(above.values())
            self.samples.append((seats, below, above, sum(above.values())))
        self.used = self.samples[burn_in + 1:]
        self.full = Counter()
        for (u, _), c in self.c.items():
            self.full[u] += c

    @staticmethod
    def discount(counts) -> float:
        once, twice = sum(c == 1 for c in counts), sum(c == 2 for c in counts)
        return min(max(once / (once + 2 * twice), 0.05), 0.95) if once + twice else 0.5

    def chance(self, u, w) -> float:
        total = 0.0
        for seats, below, above, customers in self.used:
            parent = (above[w] - self.d0 if self.train[w] else 1 + self.d0 * len(self.train)) / (1 + customers)
            if self.full[u]:
                parent = (self.c[u, w] - self.d * seats.get((u, w), 0) + (1 + self.d * below[u]) * parent) / (1 + self.full[u])
            total += parent
        return total / len(self.used)

    def score(self, text) -> float:
        tokens = tokens_of(text)
        return sum(math.log10(self.chance(u, w)) for u, w in zip(["<start>", *tokens], tokens))


def rows_of_texts():
    return [*awkward_texts(), *[(300 + i, prose(i % 7, 40, 30)) for i in range(60)], *[(500, "the the the the")] * 30, (40, "Straße STRASSE ÄÖ äö")]


def scored(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, 2, "x", True, 3) for r in rows], f"doc_id long, text string, {CLASH}")
    return pitman_yor.score(table.repartition(3), **options).collect()


def listed(rows) -> list[tuple]:
    return sorted((str(r[0]), *r[1:5], *(round(x, 6) for x in r[5:])) for r in rows)


@pytest.mark.parametrize("unit, bucket", [(8 << 20, 2_000_000), (700, 50)])
def test_scores(spark, monkeypatch, unit, bucket):
    monkeypatch.setattr(pitman_yor, "UNIT_BYTES", unit)
    monkeypatch.setattr(pitman_yor, "BUCKET_KEYS", bucket)
    rows = [r for r in rows_of_texts() if len(r[1] or "") < 5000]
    plain = Plain(rows)
    want = [(*base, plain.score(text)) for base, (_, text) in zip(base_rows(rows), rows)]
    assert listed(scored(spark, rows)) == listed(want)
    assert {fold_is_held(i) for i, _ in rows} == {True, False}
    for u in ["<start>", *list(plain.train)[:20], "never seen"]:
        assert abs(sum(plain.chance(u, w) for w in [*plain.train, "never seen either"]) - 1) < 1e-9


def test_sweeps_are_run_in_number(spark):
    rows = [(i, prose(i % 7, 40, 30)) for i in range(40)]
    plain = Plain(rows, 20, 10)
    assert len(plain.used) == 10
    assert listed(scored(spark, rows)) == listed([(*base, plain.score(text)) for base, (_, text) in zip(base_rows(rows), rows)])


def test_long_texts_and_little(spark):
    rows = rows_of_texts()
    assert [r[:5] for r in listed(scored(spark, rows, sweeps=1, burn_in=0))] == [r[:5] for r in listed([(*b, 0.0) for b in base_rows(rows)])]
    assert scored(spark, []) == []
    for rows in ([(None, None)], [(None, "only held out")], [(1, None)], [(1, "")]):
        got = scored(spark, rows)
        assert listed(got) == listed([(*b, Plain(rows).score(t)) for b, (_, t) in zip(base_rows(rows), rows)])


def test_scratch_is_small(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in draw.zipf(1.3, 400) % 4000)) for i in range(100)]
    stored, keep = {}, pitman_yor.Gathering.keep

    def kept(self, name, told):
        keep(self, name, told)
        stored[name] = sum(len(data) for row in self.told[name].collect() for data in row[name])
        stored["units"] = sum(len(value) for row in self.units.collect() for value in row if isinstance(value, (bytes, bytearray)))

    monkeypatch.setattr(pitman_yor.Gathering, "keep", kept)
    scored(spark, rows)
    words = len({w for _, text in rows for w in text.split()})
    # The texts' tokens say which pairs there are, and most words have the same tables after all sweeps.
    assert stored["units"] < 100 * 400 * 2.5 + 8 * words
    assert stored["samples"] < 12 * words


def test_tables_are_dropped(spark):
    before = [t.name for t in spark.catalog.listTables()]
    scored(spark, [(1, "a b"), (2, "b a")])
    assert [t.name for t in spark.catalog.listTables()] == before


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    rows = [(i, " ".join(f"w{(start + k) % 40}" for k in range(30))) for i, start in enumerate(np.random.default_rng(1).integers(0, 40, 300).tolist())]
    held = [r for r in scored(spark, rows) if r.held_out]
    assert sum(r.score for r in held) > 0.3 * sum(r.base_score for r in held)


def seatings(count: int):
    """All ways to seat, as sizes of tables, by coming in one after another."""
    if count == 1:
        return [(1,)]
    return [s for sizes in seatings(count - 1) for s in [*[(*sizes[:i], n + 1, *sizes[i + 1:]) for i, n in enumerate(sizes)], (*sizes, 1)]]


@pytest.mark.parametrize("base, slope, d", [(0.3, 0.2, 0.4), (2.0, 0.01, 0.7), (30.0, 0.5, 0.9)])
def test_seating_follows_its_distribution(base, slope, d):
    weights = defaultdict(float)
    for sizes in seatings(6):
        weight = math.prod(base + slope * j for j in range(len(sizes)))
        weights[len(sizes)] += weight * math.prod(k - d for n in sizes for k in range(1, n))
    key = mix(np.arange(40_000, dtype=np.uint64))
    same = np.ones(len(key))
    drawn = Counter(pitman_yor.tables((6 * same).astype(np.int64), base * same, slope * same, d, key, 1).tolist())
    for t, weight in weights.items():
        assert abs(drawn[t] / len(key) - weight / sum(weights.values())) < 0.012


@pytest.mark.parametrize("base, slope, d", [(1.5, 0.05, 0.6), (0.1, 0.01, 0.8), (20.0, 0.1, 0.75), (200.0, 0.02, 0.3)])
def test_many_customers_sit_like_the_exact_draw(base, slope, d):
    key, same = mix(np.arange(20_000, dtype=np.uint64)), np.ones(20_000)
    arguments = ((60 * same).astype(np.int64), base * same, slope * same, d, key)
    exact = pitman_yor.tables(*arguments, 1)
    trials = [pitman_yor._in_order(*arguments, 1, i) for i in range(pitman_yor.TRIALS)]
    weight = np.stack([w for _, w in trials])
    share = np.exp(weight - weight.max(axis=0))
    chosen = (np.stack([t for t, _ in trials]) * share).sum(axis=0) / share.sum(axis=0)
    assert abs(chosen.mean() - exact.mean()) < 0.05 * exact.mean()


def test_very_many_customers():
    key = mix(np.arange(1, dtype=np.uint64))
    large = pitman_yor.tables(np.array([10 ** 9]), np.array([5.0]), np.array([0.01]), 0.7, key, 1)
    assert 1 <= large[0] < 10_000


@pytest.mark.parametrize("n, p", [(5, 0.3), (5, 0.9), (400, 0.01), (400, 0.5), (1, 0.2), (10_000, 0.4)])
def test_binomial(n, p):
    u = pitman_yor.uniform(mix(np.arange(50_000, dtype=np.uint64)), 3, 4)
    drawn = pitman_yor.binomial(u, np.full(len(u), float(n)), np.full(len(u), p))
    assert drawn.min() >= 0 and drawn.max() <= n
    assert abs(drawn.mean() - n * p) < 0.02 * math.sqrt(n * p * (1 - p)) + 1e-9
    assert abs(drawn.std() / math.sqrt(n * p * (1 - p)) - 1) < 0.03

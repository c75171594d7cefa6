"""The language model against plain loops: likelihoods, expected counts, word counts."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from conftest import DATA
from roadevents.llm import hmm
from roadevents.llm.language_id import is_held_out


def chances(states, classes, seed=1):
    return hmm._first(np.random.default_rng(seed).integers(0, 9, classes), states)


def slow_log10(sequence, c):
    now, total = c.start * c.emits[:, sequence[0]], 0.0
    for symbol in [*sequence[1:], None]:
        total += math.log10(now.sum())
        now = now / now.sum()
        if symbol is not None:
            now = (now @ c.moves) * c.emits[:, symbol]
    return total


@pytest.mark.parametrize("lengths", [[1], [1, 2, 63, 64, 65, 200], [500, 1, 128]])
def test_likelihood(lengths):
    dice, c = np.random.default_rng(2), chances(3, 7)
    sequences = [dice.integers(0, 7, n) for n in lengths]
    got = hmm.log10_likelihood(sequences, c)
    assert got == pytest.approx([slow_log10(s, c) for s in sequences])
    assert len(hmm.log10_likelihood([], c)) == 0


def test_all_sequences_sum_to_one():
    c = chances(3, 4)
    every = [np.array([a, b, d]) for a in range(4) for b in range(4) for d in range(4)]
    assert sum(10 ** hmm.log10_likelihood(every, c)) == pytest.approx(1.0)


def slow_counts(sequence, c, start):
    """Expected counts by adding up all paths."""
    k, n = len(c.start), len(sequence)
    paths = np.array(np.meshgrid(*[range(k)] * n, indexing="ij")).reshape(n, -1).T
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(c.emits)
    weights = []
    for p in paths:
        w = start[p[0]] * c.emits[p[0], sequence[0]]
        for t in range(1, n):
            w *= c.moves[p[t - 1], p[t]] * c.emits[p[t], sequence[t]]
        weights.append(w)
    for p, w in zip(paths, np.array(weights) / sum(weights)):
        starts[p[0]] += w
        for t in range(n):
            emits[p[t], sequence[t]] += w
            if t:
                moves[p[t - 1], p[t]] += w
    return starts, moves, emits


def test_expected_counts():
    dice, c = np.random.default_rng(4), chances(2, 5)
    sequences = [dice.integers(0, 5, n) for n in (1, 4, 7)]
    got = hmm.expected_counts(sequences, c)
    parts = [slow_counts(s, c, c.start) for s in sequences]
    for own, expected in zip(got, zip(*parts)):
        assert own == pytest.approx(sum(expected))
    # A second segment starts from the chain's stationary distribution.
    long = dice.integers(0, 5, hmm.SEGMENT + 3)
    alone = slow_counts(long[hmm.SEGMENT :], c, hmm._stationary(c.moves))
    whole = hmm.expected_counts([long], c)
    head = hmm.expected_counts([long[: hmm.SEGMENT]], c)
    assert whole[2] - head[2] == pytest.approx(alone[2])
    assert whole[1] - head[1] == pytest.approx(alone[1])
    assert whole[0] == pytest.approx(head[0])


def rows():
    dice = random.Random(8)
    words = ["".join(dice.choices("abcdeé", k=dice.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(dice.choices(words, k=dice.randint(0, 90))).title() for _ in range(80)]
    out = [(i, i % 4 == 1, t) for i, t in enumerate(texts)]
    out += [(5, True, texts[0]), (5, True, texts[0]), (None, False, None), (90, True, "")]
    out += [(91, False, "x" * 500 + " y\tz\x0bé"), (92, True, "unseen words only"), (93, True, "a " * 9000)]
    return out


@pytest.mark.parametrize("shipped", [hmm.SHIPPED, 0.004])
def test_scores(spark, monkeypatch, shipped):
    monkeypatch.setattr(hmm, "SHIPPED", shipped)
    monkeypatch.setattr(hmm, "OWN_CLASS", 0.005)
    data = rows()
    docs = spark.createDataFrame(
        [(*r, "q", 1) for r in data], "doc_id long, held_out boolean, text string, word string, c int"
    )
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for _, held, t in data if not held for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    got = hmm.score(docs, iterations=1).collect()
    # The same model by plain loops over every word.
    own = {w for w, c in counts.items() if c >= 0.005 * total} | {b""}
    places = {w: hmm.SUFFIX_CLASSES + i for i, w in enumerate(sorted(own, key=hmm.word_key))}
    cls = lambda w: places.get(w, hmm.suffix_class(w))
    occurs, v = np.zeros(hmm.SUFFIX_CLASSES + len(own)), Counter()
    for w, c in counts.items():
        occurs[cls(w)] += c
        v[cls(w)] += 1
    lexicon, words_occur = hmm._lexicon(hmm.vocabulary(docs.where("not held_out").fillna({"text": ""})), total)
    assert words_occur == pytest.approx(occurs)
    learned = docs.where("not held_out").fillna({"text": ""})
    model = hmm.train(learned, lexicon, occurs, hmm.STATES, 1)
    expected = []
    for doc, held, text in data:
        sequence = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in sequence)
        value = slow_log10([cls(w) for w in sequence], model)
        for w in sequence:
            if w not in own:
                k = cls(w)
                value += math.log10((counts[w] + 0.5) / (occurs[k] + 0.5 * (v[k] + 1)))
        known = sum(counts[w] > 0 for w in sequence)
        expected.append((doc, held, len(sequence), known, total, base, value))
    key = lambda r: (str(r[0]), r[2], r[3])
    got = sorted(map(tuple, got), key=key)
    expected.sort(key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for column in (5, 6):
        assert [r[column] for r in got] == pytest.approx([r[column] for r in expected], rel=1e-9)


def test_no_training_and_no_rows(spark):
    docs = spark.createDataFrame([(1, True, "a b"), (2, True, None)], "doc_id long, held_out boolean, text string")
    got = {r["doc_id"]: r for r in hmm.score(docs).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0
    assert got[1]["base_score"] == pytest.approx(0) and got[1]["score"] < 0
    assert hmm.score(docs.limit(0)).count() == 0


def test_better_than_counts_on_held_out_text(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    docs = docs.withColumn("held_out", is_held_out(docs["doc_id"], 5, 1))
    row = hmm.score(docs).where("held_out").selectExpr("sum(base_score) b", "sum(score) s").first()
    assert row["s"] > row["b"]


def scaled_counts(sequence, c):
    """Expected counts of one whole sequence, by forward and backward vectors."""
    n, k = len(sequence), len(c.start)
    forward, backward, scales = np.zeros((n, k)), np.ones((n, k)), np.zeros(n)
    for t in range(n):
        now = (forward[t - 1] @ c.moves if t else c.start) * c.emits[:, sequence[t]]
        scales[t] = now.sum()
        forward[t] = now / scales[t]
    for t in range(n - 2, -1, -1):
        ahead = c.emits[:, sequence[t + 1]] * backward[t + 1]
        backward[t] = c.moves @ ahead / scales[t + 1]
    moves, emits = np.zeros((k, k)), np.zeros_like(c.emits)
    for t in range(n):
        emits[:, sequence[t]] += forward[t] * backward[t]
        if t:
            ahead = c.emits[:, sequence[t]] * backward[t] / scales[t]
            moves += forward[t - 1][:, None] * c.moves * ahead
    return forward[0] * backward[0], moves, emits


def test_counts_of_whole_sequences():
    dice, c = np.random.default_rng(5), chances(3, 5)
    lengths = [1, 63, 64, 65, 128, 129, 500, 7]
    sequences = [dice.integers(0, 5, n) for n in lengths]
    got = hmm.expected_counts(sequences, c, whole=True)
    for own, expected in zip(got, zip(*[scaled_counts(s, c) for s in sequences])):
        assert own == pytest.approx(sum(expected))
    assert got[1].sum() == pytest.approx(sum(n - 1 for n in lengths))
    short = scaled_counts(sequences[7], c)
    assert [x.sum() for x in short] == pytest.approx([1, 6, 7])
    assert short[1] == pytest.approx(slow_counts(sequences[7], c, c.start)[1])


def test_training_counts_whole_texts(monkeypatch):
    asked = []

    def counts(sequences, c, whole=False):
        asked.append(whole)
        return [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]

    monkeypatch.setattr(hmm, "expected_counts", counts)
    read = np.zeros(3, "<i2").tobytes()
    list(hmm._cells([hmm.pa.record_batch({"classes": hmm.pa.array([read])})], chances(3, 5)))
    assert asked == [True]

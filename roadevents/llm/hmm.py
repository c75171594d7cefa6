"""A hidden Markov language model over words.

Each state emits a word class and a class emits a word. The most frequent words are
classes of their own; every other word, known or not, belongs to one of a fixed number
of classes by its last three bytes, inside which its smoothed share of the counts is its
chance. Baum-Welch trains start, transition and class chances: tasks run forward and
backward over their documents in segments, and the expected counts are summed over all
partitions. Scoring multiplies the scaled transition matrices of a whole text, so its
likelihood is exact for any length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import STEP_BYTES, steps, written

STATES = 6
ITERATIONS = 5
# At first a state stays with this chance, so states find stretches of alike text.
STAY = 0.95
SEGMENT = 64
SUFFIX_CLASSES = 1024
# Words with at least this share of the training tokens: at most as many as 1 / share.
OWN_CLASS = 2.0**-12
SHIPPED = 2.0**-20
# Longer words are sent as their digests, which bounds what is sent.
SHIPPED_BYTES = 64
# Matrix products are scaled after so many tokens; chances stay far above the least double.
SCALED = 16
END = b""
SEED = 9
# Expected counts are summed as whole multiples of this.
UNIT = 2.0**-20


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX_CLASSES


def word_key(word: bytes) -> bytes:
    """The word, or for a long one a byte that no word has and a digest."""
    return word if len(word) <= SHIPPED_BYTES else b"\xff" + hashlib.md5(word).digest()


@dataclass
class Lexicon:
    """The frequent words, their counts and classes. The last class is the end's."""

    index: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    n_classes: int
    # For classes by suffix, log10 of what a smoothed count is divided by.
    log_totals: np.ndarray

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Each token's place among the frequent words (-1: none), its class, and the
        words that have no place."""
        words = text.encode().lower().split()
        words.append(END)
        get = self.index.get
        place = np.array([get(w, -1) for w in words], np.int64)
        missing = np.flatnonzero(place < 0)
        rare = [words[i] for i in missing.tolist()]
        if rare and max(map(len, rare)) > SHIPPED_BYTES:
            place[missing] = [get(word_key(w), -1) for w in rare]
            missing = np.flatnonzero(place < 0)
            rare = [words[i] for i in missing.tolist()]
        classes = self.classes[place]
        classes[missing] = [suffix_class(w) for w in rare]
        return place, classes, rare


@dataclass
class Chances:
    start: np.ndarray
    moves: np.ndarray
    # States by classes; one more class of chance 1 pads segments.
    emits: np.ndarray


def _padded(emits: np.ndarray) -> np.ndarray:
    return np.concatenate([emits, np.ones((len(emits), 1))], axis=1)


def _stationary(moves: np.ndarray) -> np.ndarray:
    found = np.full(len(moves), 1 / len(moves))
    for _ in range(200):
        found = found @ moves
    return found / found.sum()


def _segments(sequences: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places by segment, which are first in their sequence, and how many each has."""
    sizes = np.array([-(-len(s) // SEGMENT) for s in sequences], np.int64)
    table = np.full((int(sizes.sum()), SEGMENT), pad, np.int64)
    flat, at = table.reshape(-1), 0
    for own, size in zip(sequences, sizes.tolist(), strict=True):
        flat[at * SEGMENT : at * SEGMENT + len(own)] = own
        at += size
    first = np.zeros(len(table), bool)
    first[np.cumsum(sizes) - sizes] = True
    return table.T.copy(), first, sizes


def _matrices(
    symbols: np.ndarray, first: np.ndarray, chances: Chances
) -> tuple[np.ndarray, np.ndarray]:
    """Each segment's chances from the state before it to its last, scaled, and the scale's log10."""
    pad = chances.emits.shape[1]
    emits, moves, states = _padded(chances.emits).T.copy(), chances.moves, len(chances.moves)
    # A sequence starts without a move, and padding changes nothing.
    found = np.where(first[:, None, None], np.eye(states), moves)
    logs = np.zeros(symbols.shape[1])
    for t in range(SEGMENT):
        if t:
            ended = np.flatnonzero(symbols[t] == pad)
            kept = found[ended]
            found = (found.reshape(-1, states) @ moves).reshape(found.shape)
            found[ended] = kept
        found *= emits[symbols[t]][:, None, :]
        if t % SCALED == SCALED - 1 or t == SEGMENT - 1:
            scale = found.sum(axis=(1, 2))
            logs += np.log10(scale)
            found /= scale[:, None, None]
    return found, logs


def _borders(symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, chances: Chances):
    """For each segment the states' chances just before it, given what comes earlier in its
    sequence, and the backward vector at its end; of a column each."""
    states, width = len(chances.moves), symbols.shape[1]
    before, after = np.zeros((width, states)), np.ones((width, states))
    long = np.repeat(sizes > 1, sizes)
    found = np.zeros((width, states, states))
    found[long], _ = _matrices(symbols[:, long], first[long], chances)
    begin = np.cumsum(sizes) - sizes
    most = int(sizes.max(initial=0))
    before[begin[sizes > 0]] = chances.start
    for r in range(1, most):
        at = begin[sizes > r] + r
        ahead = np.einsum("dk,dkj->dj", before[at - 1], found[at - 1])
        before[at] = ahead / ahead.sum(axis=1)[:, None]
    for r in range(most - 1, 0, -1):
        at = begin[sizes > r] + r
        back = np.einsum("dkj,dj->dk", found[at], after[at])
        after[at - 1] = back / back.sum(axis=1)[:, None]
    return before.T, after.T


def expected_counts(
    sequences: list[np.ndarray], chances: Chances, whole: bool = False
) -> list[np.ndarray]:
    """Expected starts, moves and emissions of the sequences under ``chances``.

    With ``whole`` a sequence's segments go on from one another, and moves between them
    count; otherwise each but the first starts from the stationary distribution.
    """
    pad = chances.emits.shape[1]
    symbols, first, sizes = _segments(sequences, pad)
    emits, moves = _padded(chances.emits), chances.moves
    later = ~first
    length, width = symbols.shape
    states = len(moves)
    forward = np.empty((length, states, width))
    scales = np.empty((length, width))
    if whole:
        before, after = _borders(symbols, first, sizes, chances)
        now = np.where(first, chances.start[:, None], moves.T @ before)
    else:
        now = np.where(first, chances.start[:, None], _stationary(moves)[:, None])
    for t in range(length):
        now = (moves.T @ now if t else now) * emits[:, symbols[t]]
        scales[t] = now.sum(axis=0)
        now = now / scales[t]
        forward[t] = now
    starts, used = np.zeros(states), np.zeros((states, states))
    backward = np.ones((states, width))
    if whole:
        backward = after / (now * after).sum(axis=0)
    for t in range(length - 1, -1, -1):
        both = forward[t] * backward
        if t:
            ahead = emits[:, symbols[t]] * backward / scales[t]
            used += forward[t - 1] @ (ahead * (symbols[t] != pad)).T
            backward = moves @ ahead
            forward[t] = both
        else:
            forward[t] = both
            starts += both[:, first].sum(axis=1)
            if whole:
                ahead = emits[:, symbols[t]] * backward / scales[t]
                used += before[:, later] @ ahead[:, later].T
    # What was forward is by now the chance of each state given the whole sequence.
    flat = symbols.reshape(-1)
    emitted = [
        np.bincount(flat, weights=forward[:, k].reshape(-1), minlength=pad + 1)[:pad]
        for k in range(states)
    ]
    return [starts, used * moves, np.stack(emitted)]


def log10_likelihood(sequences: list[np.ndarray], chances: Chances) -> np.ndarray:
    """log10 of each whole sequence's chance: products of scaled matrices per segment,
    then of the segments' matrices along each sequence."""
    pad = chances.emits.shape[1]
    symbols, first, sizes = _segments(sequences, pad)
    found, logs = _matrices(symbols, first, chances)
    begin = np.cumsum(sizes) - sizes
    total = np.zeros(len(sequences))
    state = np.tile(chances.start, (len(sequences), 1))
    for r in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > r)
        at = begin[own] + r
        ahead = np.einsum("dk,dkj->dj", state[own], found[at])
        scale = ahead.sum(axis=1)
        total[own] += np.log10(scale) + logs[at]
        state[own] = ahead / scale[:, None]
    return total


def _word_counts(batches: Iterator[pa.RecordBatch]):
    counts: Counter[bytes] = Counter()

    def rows():
        return pa.record_batch(
            {
                "word": pa.array([w.decode() for w in counts], pa.string()),
                "c": pa.array(counts.values(), pa.int64()),
            }
        )

    for batch in steps(batches):
        for text in batch.column("text").to_pylist():
            counts.update(text.encode().lower().split())
            counts[END] += 1
        if len(counts) > 500_000:
            yield rows()
            counts.clear()
    yield rows()


def vocabulary(texts: DataFrame) -> DataFrame:
    """word and c, its count, over all texts; the empty word is the end of a text."""
    parts = texts.select("text").mapInArrow(_word_counts, "word string, c bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def _lexicon(words: DataFrame, total: int) -> tuple[Lexicon, np.ndarray]:
    """The words to send, and how often each class occurs.

    The driver receives at most 1 / SHIPPED words of at most SHIPPED_BYTES bytes, or
    digests of longer ones, and two numbers per suffix class.
    """
    end = F.col("word") == ""
    own = (F.col("c") >= F.greatest(F.lit(1), F.ceil(F.lit(total * OWN_CLASS)))) | end
    spelling = F.col("word").cast("binary")
    digest = F.concat(F.unhex(F.lit("FF")), F.unhex(F.md5(spelling)))
    key = F.when(F.octet_length("word") <= SHIPPED_BYTES, spelling).otherwise(digest)
    ending = F.crc32(F.substring(spelling, -3, 3)) % SUFFIX_CLASSES
    sent = words.where((F.col("c") >= total * SHIPPED) | end)
    sent = sent.select(key.alias("key"), "c", own.alias("own"), ending.alias("class"))
    sent = sent.toArrow().sort_by("key")
    keys = sent.column("key").to_pylist()
    counts, alone = sent.column("c").to_numpy(), np.array(sent.column("own").to_pylist(), bool)
    classes = sent.column("class").to_numpy().astype(np.int64)
    if END not in keys:
        keys, counts, alone = [*keys, END], np.append(counts, 0), np.append(alone, True)
        classes = np.append(classes, 0)
    classes[alone] = SUFFIX_CLASSES + np.arange(alone.sum())
    n_classes = SUFFIX_CLASSES + int(alone.sum())
    rest = words.where(~own).groupBy(ending.alias("class"))
    occurs, kinds = np.zeros(n_classes), np.zeros(SUFFIX_CLASSES)
    for row in rest.agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        occurs[row["class"]], kinds[row["class"]] = row["c"], row["v"]
    occurs[classes[alone]] = counts[alone]
    log_totals = np.log10(occurs[:SUFFIX_CLASSES] + 0.5 * (kinds + 1))
    index = {w: i for i, w in enumerate(keys)}
    return Lexicon(index, counts, classes, n_classes, log_totals), occurs


def _classes(batches: Iterator[pa.RecordBatch], lexicon: Lexicon):
    for batch in steps(batches):
        read = [lexicon.read(t)[1].astype("<i2").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.record_batch([pa.array(read, pa.binary())], names=["classes"])


def _cells(batches: Iterator[pa.RecordBatch], chances: Chances):
    total: list[np.ndarray] | None = None
    # Two bytes a token, where a text has some six.
    for batch in steps(batches, "classes", STEP_BYTES // 3):
        sequences = [np.frombuffer(c, "<i2").astype(np.int64) for c in batch.column("classes").to_pylist()]
        found = expected_counts(sequences, chances, whole=True)
        total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
    if total is not None:
        flat = np.rint(np.concatenate([x.reshape(-1) for x in total]) / UNIT).astype(np.int64)
        some = np.flatnonzero(flat)
        yield pa.record_batch({"cell": pa.array(some), "units": pa.array(flat[some])})


def _first(occurs: np.ndarray, states: int) -> Chances:
    """Class chances near the plain shares, a little different in every state."""
    dice = np.random.default_rng(SEED)
    emits = (occurs + 1.0) * dice.uniform(0.5, 1.5, (states, len(occurs)))
    moves = dice.uniform(0.5, 1.5, (states, states))
    start = dice.uniform(0.5, 1.5, states)
    moves = (1 - STAY) * moves / moves.sum(axis=1, keepdims=True) + STAY * np.eye(states)
    return Chances(
        start / start.sum(),
        moves,
        emits / emits.sum(axis=1, keepdims=True),
    )


def train(
    texts: DataFrame, lexicon: Lexicon, occurs: np.ndarray, states: int, iterations: int
) -> Chances:
    """Baum-Welch over all texts, each as a whole. The driver receives a number per parameter.

    The texts' classes are written once; the rounds read these.
    """
    chances = _first(occurs, states)
    sent = texts.sparkSession.sparkContext.broadcast(lexicon)
    read = texts.select("text").mapInArrow(lambda b: _classes(b, sent.value), "classes binary")
    read = written(read, "classes")
    shares = (occurs + 1.0) / (occurs + 1.0).sum()
    for _ in range(iterations):
        parts = read.mapInArrow(lambda b, c=chances: _cells(b, c), "cell bigint, units bigint")
        size = states + states * states + states * lexicon.n_classes
        flat = np.zeros(size)
        for row in parts.groupBy("cell").agg(F.sum("units").alias("units")).collect():
            flat[row["cell"]] = row["units"] * UNIT
        start, moves, emits = np.split(flat, [states, states + states * states])
        moves, emits = moves.reshape(states, states) + 0.1, emits.reshape(states, -1) + shares
        chances = Chances(
            (start + 0.1) / (start + 0.1).sum(),
            moves / moves.sum(axis=1, keepdims=True),
            emits / emits.sum(axis=1, keepdims=True),
        )
    return chances


def _scores(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, chances: Chances, arrow: pa.Schema):
    logs = np.log10(lexicon.counts + 0.5)
    by_suffix = lexicon.classes < SUFFIX_CLASSES
    for batch in steps(batches):
        read = [lexicon.read(t) for t in batch.column("text").to_pylist()]
        likely = log10_likelihood([r[1] for r in read], chances)
        out: dict[str, list] = {n: [] for n in arrow.names}
        words, times, ends = [], [], [0]
        for (place, classes, rare), hidden in zip(read, likely.tolist(), strict=True):
            known = place[place >= 0]
            suffixed = classes[classes < SUFFIX_CLASSES]
            out["n_tokens"].append(len(place))
            out["sent_known"].append(int((lexicon.counts[known] > 0).sum()))
            out["sent_logs"].append(float(logs[known].sum()))
            # The classes' chances, and the words' inside them but for the rare counts.
            inside = logs[known[by_suffix[known]]].sum() - lexicon.log_totals[suffixed].sum()
            out["model_part"].append(hidden + float(inside))
            found = Counter(rare)
            words += found
            times += found.values()
            ends.append(len(words))
        out["doc_id"], out["held_out"] = batch.column("doc_id"), batch.column("held_out")
        pairs = [pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
        kind = arrow.field("rare").type.value_type
        pairs = pa.StructArray.from_arrays(pairs, fields=list(kind))
        out["rare"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        columns = [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(out.values(), arrow)]
        yield pa.record_batch(columns, schema=arrow)


SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, sent_known bigint, sent_logs double, "
    "model_part double, rare array<struct<word:string,n:bigint>>"
)


def score(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Scores the rows of ``docs`` (doc_id, held_out, text) by those not held out.

    ``base_score`` is the smoothed unigram score, ``score`` the model's; both are log10
    of the text's chance. Null text is empty: the end alone. Null doc_ids and repeated
    rows are scored like others, other columns are left out. Without training texts
    every token's base score is 0, and the model's classes are near even.

    Counts of frequent words go to the tasks. A text's other words meet their counts in
    a join, so nothing that grows with the vocabulary is sent.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = docs.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text"))
    learned = rows.where(~F.col("held_out"))
    words = written(vocabulary(learned), "vocabulary")
    sums = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, kinds = sums["n"] or 0, sums["v"]
    lexicon, occurs = _lexicon(words, total)
    chances = train(learned, lexicon, occurs, states, iterations)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    arrow = to_arrow_schema(StructType.fromDDL(SCORED))
    parts = rows.mapInArrow(lambda b: _scores(b, sent.value, chances, arrow), SCORED)
    # The row's number stays fixed once it is written.
    parts = written(parts.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    counted = rare.join(words, "word", "left").select(
        "row",
        (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
    )
    counted = counted.groupBy("row").agg(F.sum("logs").alias("logs"), F.sum("known").alias("known"))
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    whole = float(np.log10(total + 0.5 * (kinds + 1)))
    return parts.drop("rare").join(counted, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("sent_known") + known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sent_logs") + logs - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model_part") + logs).alias("score"),
    )

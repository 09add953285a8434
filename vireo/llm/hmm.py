"""Operator 6: hidden Markov language model with exact likelihoods.

Tokens are words (A-Z lower-cased) and one end per text.  States emit word classes, and a
class emits its words by their training counts: the most frequent words are classes of their
own, other repeated words share a class by their last bytes, and words seen once share the
class ``RARE`` with the one unknown type, which gets the mass that Good-Turing gives to unseen
words.  So the states' parameters have a fixed size at any vocabulary, while the word counts
stay a distributed table.

1. Texts are packed into chunks: local vocabulary, local token numbers, training counts.
2. The chunks' vocabularies meet by word (a window sums the training counts), and every chunk
   gets the totals of its own words back.  Shuffled rows follow chunks x local vocabulary.
3. Baum-Welch: every task runs scaled forward-backward over all its training segments, the
   expected counts are summed over all tasks by Spark, and the driver gets the sums, whose
   number is states x classes.
4. The scaled forward recursion over each whole text gives its exact log probability.

Training covers all texts whose crc32 remainder isn't the held-out one, whole; they are read in
segments of ``SEGMENT`` tokens, with one start distribution for text starts and one for the rest.
Baum-Welch starts from all training segments too, parted along the principal axes of their class shares.

Defined cases: null text is empty (its one token is the end); a null id counts as an empty text
in the crc32; repeated rows are scored alike and each counts; an empty table gives an empty
result; without any training text all words are unknown; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import crc_remainder, stored, text_buffers, word_hashes

STATES, ROUNDS, SEGMENT = 8, 4, 128
OWN_CLASSES, SUFFIX_CLASSES = 4096, 1024
#: Bytes of text in a chunk, and tokens that one forward-backward batch holds.
CHUNK_BYTES, BATCH_TOKENS = 16 << 20, 1 << 19
#: Weight, in tokens, of the overall class distribution in every state's emissions, and of the uniform one in transitions.
EMISSION_PRIOR, TRANSITION_PRIOR = 50.0, 1.0
#: Random directions in which segments are compared for the start, and the tokens' weight of staying in a state there.
DIRECTIONS, STAY = 32, 20.0
HELD_OUT = (7, 2)
RARE = 0
_END = np.uint64(0x9E6C63D0676A9A99)


# ---------------------------------------------------------------- chunks

_PACK = "chunk long, held array<boolean>, lengths array<int>, tokens binary, words binary, tails binary, counts binary"


def chunked(docs: DataFrame, id_col: str, text_col: str, held_out: tuple[int, int]) -> DataFrame:
    """Stored chunks of about ``CHUNK_BYTES``: ids, lengths, tokens as numbers into the chunk's sorted vocabulary."""
    field = docs.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = TaskContext.get().partitionId(), 0, [], 0

        def chunk():
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            out = [crc_remainder(x, held_out[0]) == held_out[1] for x in batch.column("id").to_pylist()]
            found, per, tails = word_hashes(batch.column("text"), lower=True, suffixes=(3,))
            lengths = per + 1
            ends = np.cumsum(lengths) - 1
            flat, last = np.full(int(lengths.sum()), _END), np.zeros(int(lengths.sum()), np.uint64)
            word = np.ones(len(flat), dtype=bool)
            word[ends] = False
            flat[word], last[word] = found, tails
            words, first, tokens = np.unique(flat.view(np.int64), return_index=True, return_inverse=True)
            training = np.repeat(~np.array(out, dtype=bool), lengths)
            counts = np.bincount(tokens[training], minlength=len(words)).astype(np.int64)
            tail = (last[first] % np.uint64(SUFFIX_CLASSES)).astype(np.int16)
            return pa.RecordBatch.from_arrays([pa.array([batch.column("id").to_pylist()], pa.list_(batch.schema.field("id").type)), pa.array([part << 24 | nth]), pa.array([out]), pa.array([lengths.tolist()], pa.list_(pa.int32())), *[pa.array([x.tobytes()]) for x in (tokens.astype(np.int32), words, tail, counts)]], ["ids", "chunk", "held", "lengths", "tokens", "words", "tails", "counts"])

        for batch in batches:
            sizes = np.diff(text_buffers(batch.column("text"))[1])
            at = 0
            while at < batch.num_rows:
                total = size + np.cumsum(sizes[at:])
                n = max(1, int(np.searchsorted(total, CHUNK_BYTES, "right")))
                held.append(batch.slice(at, n))
                size += int(sizes[at:at + n].sum())
                at += n
                if size >= CHUNK_BYTES or at < batch.num_rows:
                    yield chunk()
                    nth, held, size = nth + 1, [], 0
        if held:
            yield chunk()

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(source.mapInArrow(pack, f"ids array<{field}>, {_PACK}"), "lm-chunks")


def counted(chunks: DataFrame) -> DataFrame:
    """Stored (chunk, totals, first): corpus counts of a chunk's sorted words, and which words the chunk speaks for."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w, n = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("words", "counts"))
                for lo in range(0, len(w), 50_000):
                    part = w[lo:lo + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), batch.column("chunk")[i].as_py())), pa.array(part), pa.array(n[lo:lo + 50_000])], ["chunk", "word", "n"])

    rows = chunks.select("chunk", "words", "counts").mapInArrow(words, "chunk long, word long, n long")
    same = Window.partitionBy("word")
    total = rows.select("chunk", "word", F.sum("n").over(same).alias("total"), (F.min("chunk").over(same) == F.col("chunk")).alias("first"))

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, totals, firsts = None, [], []
        row = lambda: pa.RecordBatch.from_arrays([pa.array([key]), pa.array([np.concatenate(totals).tobytes()]), pa.array([np.concatenate(firsts).tobytes()])], ["chunk", "totals", "first"])
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            t, f = batch.column("total").to_numpy(), batch.column("first").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1), len(chunk)]
            for lo, hi in zip(edges, edges[1:]):
                if chunk[lo] != key:
                    if totals:
                        yield row()
                    key, totals, firsts = int(chunk[lo]), [], []
                totals.append(t[lo:hi])
                firsts.append(f[lo:hi])
        if totals:
            yield row()

    dealt = total.repartition("chunk").sortWithinPartitions("chunk", "word")
    return stored(dealt.mapInArrow(regroup, "chunk long, totals binary, first binary"), "lm-totals")


# ---------------------------------------------------------------- classes

class Lexicon:
    """What tasks need to know about the corpus: its sums, and the words that are classes of their own."""

    def __init__(self, tokens: int, types: int, once: int, twice: int, own: np.ndarray, class_total: np.ndarray):
        self.tokens, self.types, self.once, self.twice = tokens, types, once, twice
        self.own, self.class_total = own, class_total
        self.unknown = max(once, 1) / (max(once, 1) + 2 * twice)

    @property
    def classes(self) -> int:
        return 1 + SUFFIX_CLASSES + len(self.own)

    def class_of(self, words: np.ndarray, totals: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """RARE for words seen once or never, then the suffix classes, then the words of their own."""
        out = np.where(totals > 1, 1 + tails.astype(np.int64), RARE)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
            out = np.where((self.own[at] == words) & (totals > 1), 1 + SUFFIX_CLASSES + at, out)
        return out

    def log_in_class(self, classes: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """log10 P(word | class); an unknown word is the one unknown type."""
        rare = np.where(totals > 0, np.log10(max(1 - self.unknown, 1e-300) / max(self.once, 1)), np.log10(self.unknown))
        shared = np.log10(np.maximum(totals, 1) / np.maximum(self.class_total[classes], 1))
        return np.where(classes == RARE, rare, shared)


def lexicon(chunks: DataFrame, totals: DataFrame) -> Lexicon:
    """Sums over the distinct words of all chunks; the driver gets one row, ``OWN_CLASSES`` words and the class sums."""
    both = chunks.select("chunk", "words", "tails").join(totals, "chunk")

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w, t = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("words", "totals"))
                mine = np.frombuffer(batch.column("first")[i].as_py(), bool) & (t > 1)
                w, t = w[mine], t[mine]
                best = np.lexsort((w, -t))[:OWN_CLASSES]
                yield pa.RecordBatch.from_arrays([pa.array(w[best]), pa.array(t[best])], ["word", "n"])

    frequent = both.mapInArrow(top, "word long, n long").orderBy(F.desc("n"), "word").limit(OWN_CLASSES)
    own = np.sort(np.array([r["word"] for r in frequent.collect()], dtype=np.int64))
    draft = Lexicon(0, 0, 0, 0, own, np.zeros(1 + SUFFIX_CLASSES + len(own)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per, facts = np.zeros(draft.classes), np.zeros(4)
        for batch in batches:
            for i in range(batch.num_rows):
                w, t = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("words", "totals"))
                tails = np.frombuffer(batch.column("tails")[i].as_py(), np.int16)
                mine = np.frombuffer(batch.column("first")[i].as_py(), bool)
                w, t, tails = w[mine], t[mine], tails[mine]
                per += np.bincount(draft.class_of(w, t, tails), t, minlength=draft.classes)
                facts += t.sum(), (t > 0).sum(), (t == 1).sum(), (t == 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([[*facts, *per]], pa.list_(pa.float64()))], ["v"])

    found = _summed(both.mapInArrow(sums, "v array<double>"), 4 + draft.classes)
    return Lexicon(*(int(x) for x in found[:4]), own, found[4:])


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Elementwise sum of equally long arrays, added up by Spark."""
    out = np.zeros(size)
    for r in rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r["i"]] = r["x"]
    return out


_READY = "chunk long, held array<boolean>, lengths array<int>, classes binary, base array<double>, inside array<double>, known array<long>"


def classed(chunks: DataFrame, totals: DataFrame, lex: Lexicon) -> DataFrame:
    """Stored chunks with class numbers for tokens, and each text's base score, in-class log and known tokens."""

    def ready(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w, t = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("words", "totals"))
                tails = np.frombuffer(batch.column("tails")[i].as_py(), np.int16)
                tokens = np.frombuffer(batch.column("tokens")[i].as_py(), np.int32)
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                classes = lex.class_of(w, t, tails)
                starts = np.cumsum(lengths) - lengths
                per_text = lambda v: np.add.reduceat(v[tokens], starts)
                base = per_text(np.log10((t + 1) / (lex.tokens + lex.types + 1)))
                inside = per_text(lex.log_in_class(classes, t))
                known = per_text((t > 0).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1), *[batch.column(c).slice(i, 1) for c in ("chunk", "held", "lengths")], pa.array([classes.astype(np.uint16)[tokens].tobytes()]), pa.array([base], pa.list_(pa.float64())), pa.array([inside], pa.list_(pa.float64())), pa.array([known], pa.list_(pa.int64()))], ["ids", "chunk", "held", "lengths", "classes", "base", "inside", "known"])

    both = chunks.select("ids", "chunk", "held", "lengths", "tokens", "words", "tails").join(totals.select("chunk", "totals"), "chunk")
    return stored(both.mapInArrow(ready, f"ids {chunks.schema['ids'].dataType.simpleString()}, {_READY}"), "lm-classes")


# ---------------------------------------------------------------- Baum-Welch

class Model:
    """start (2 x K: text starts, other segments), move (K x K), emit (K x C)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit


def segments(classes: np.ndarray, lengths: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, length, whether it starts a text) of every segment, longest first."""
    per = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(lengths) - lengths)[text] + nth * size
    length = np.minimum(size, lengths[text] - nth * size)
    order = np.argsort(-length, kind="stable")
    return first[order], length[order], (nth == 0)[order]


def expected_counts(classes: np.ndarray, first: np.ndarray, length: np.ndarray, opening: np.ndarray, model: Model):
    """Scaled forward-backward over segments (longest first): start, transition and emission counts, log10 likelihood."""
    k, steps, n = len(model.move), int(length[0]), len(first)
    emit, move = np.ascontiguousarray(model.emit.T, dtype=np.float32), model.move.astype(np.float32)
    active = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
    alpha = np.zeros((steps, n, k), dtype=np.float32)
    scale = np.ones((steps, n), dtype=np.float32)
    seen = []
    now = np.where(opening[:, None], model.start[0], model.start[1]).astype(np.float32)
    for t in range(steps):
        a = active[t]
        seen.append(classes[first[:a] + t])
        now = (now[:a] if t == 0 else now[:a] @ move) * emit[seen[t]]
        s = now.sum(axis=1)
        now /= s[:, None]
        alpha[t, :a], scale[t, :a] = now, s
    beta = np.ones((n, k), dtype=np.float32)
    moved = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        a = active[t]
        if t + 1 < steps:
            b = active[t + 1]
            ahead = emit[seen[t + 1]] * beta[:b] / scale[t + 1, :b, None]
            moved += (alpha[t, :b].T @ ahead).astype(np.float64)
            beta[:b] = ahead @ move.T
        # from here alpha holds the state posteriors
        alpha[t, :a] *= beta[:a]
    moved *= model.move
    started = np.stack([alpha[0, opening].sum(axis=0, dtype=np.float64), alpha[0, ~opening].sum(axis=0, dtype=np.float64)])
    flat = np.concatenate(seen)
    posterior = np.concatenate([alpha[t, :active[t]] for t in range(steps)])
    emitted = np.stack([np.bincount(flat, posterior[:, j], minlength=len(emit)) for j in range(k)])
    return started, moved, emitted, float(np.log10(scale).sum(dtype=np.float64))


def _training(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers and lengths of a chunk's training texts."""
    classes = np.frombuffer(batch.column("classes")[i].as_py(), np.uint16)
    lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
    keep = ~np.array(batch.column("held")[i].as_py(), dtype=bool)
    return classes[np.repeat(keep, lengths)], lengths[keep]


def baum_welch_round(ready: DataFrame, model: Model, lex: Lexicon) -> tuple[Model, float]:
    """One round over all training texts; returns the new model and the log10 likelihood under the old one."""
    k, c = model.emit.shape

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit, likelihood = np.zeros((2, k)), np.zeros((k, k)), np.zeros((k, c)), 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                classes, lengths = _training(batch, i)
                if not len(lengths):
                    continue
                first, length, opening = segments(classes, lengths)
                rows = max(1, BATCH_TOKENS // SEGMENT)
                for lo in range(0, len(first), rows):
                    s, m, e, l10 = expected_counts(classes, first[lo:lo + rows], length[lo:lo + rows], opening[lo:lo + rows], model)
                    start, move, emit, likelihood = start + s, move + m, emit + e, likelihood + l10
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[likelihood], start.ravel(), move.ravel(), emit.ravel()])], pa.list_(pa.float64()))], ["v"])

    found = _summed(ready.select("held", "lengths", "classes").mapInArrow(expect, "v array<double>"), 1 + 2 * k + k * k + k * c)
    start, move, emit = np.split(found[1:], [2 * k, 2 * k + k * k])
    return estimate(start.reshape(2, k), move.reshape(k, k), emit.reshape(k, c), lex), float(found[0])


def estimate(start: np.ndarray, move: np.ndarray, emit: np.ndarray, lex: Lexicon) -> Model:
    """Smoothed parameters from counts; the rare class gets the mass of unseen words on top."""
    grown = emit.copy()
    grown[:, RARE] = grown[:, RARE] * (max(lex.once, 1) + 2 * lex.twice) / max(lex.once, 1)
    overall = np.maximum(lex.class_total, 0.5)
    overall = overall / overall.sum()
    grown += EMISSION_PRIOR * overall
    return Model((start + TRANSITION_PRIOR) / (start + TRANSITION_PRIOR).sum(axis=1, keepdims=True),
                 (move + TRANSITION_PRIOR) / (move + TRANSITION_PRIOR).sum(axis=1, keepdims=True),
                 grown / grown.sum(axis=1, keepdims=True))


def _pieces(classes: np.ndarray, lengths: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(tokens' classes, first tokens of segments) in the order of the text, in batches of whole segments."""
    per = -(-lengths // size)
    nth = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    first = np.repeat(np.cumsum(lengths) - lengths, per) + nth * size
    rows = max(1, BATCH_TOKENS // size // 8)
    for lo in range(0, len(first), rows):
        end = first[lo + rows] if lo + rows < len(first) else len(classes)
        yield classes[first[lo]:end], first[lo:lo + rows] - first[lo]


def _places(classes: np.ndarray, first: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Each segment's mean of its tokens' rows of ``spread``."""
    return np.add.reduceat(spread[classes], first).astype(np.float64) / np.diff(np.append(first, len(classes)))[:, None]


def class_directions(lex: Lexicon, size: int = DIRECTIONS) -> np.ndarray:
    """A fixed row of signs for each class, over the fourth root of the class's share, so that frequent classes don't outweigh the rest."""
    signs = np.where(np.random.default_rng(1).random((lex.classes, size)) < 0.5, -1.0, 1.0)
    share = np.maximum(lex.class_total, 1.0) / max(lex.class_total.sum(), 1.0)
    return (signs / share[:, None] ** 0.25).astype(np.float32)


def starting_model(ready: DataFrame, lex: Lexicon, states: int = STATES) -> Model:
    """States seeded by all training segments: they fall apart along the main axes of their class shares.

    One pass sums the moments of all segments' places (``class_directions``), the signs along the first
    log2(``states``) principal axes give a segment its state, and a second pass sums the states' class counts.
    Segments don't cross texts, so chunks and partitions have no say in the result.
    """
    spread, c = class_directions(lex), lex.classes
    size, bits = spread.shape[1], (states - 1).bit_length()

    def gathered(each, width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                for i in range(batch.num_rows):
                    for classes, first in _pieces(*_training(batch, i)):
                        total += each(classes, first)
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

        return _summed(ready.select("held", "lengths", "classes").mapInArrow(run, "v array<double>"), width)

    def moments(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        at = _places(classes, first, spread)
        return np.concatenate([[len(at)], at.sum(axis=0), (at.T @ at).ravel()])

    found = gathered(moments, 1 + size + size * size)
    n = max(found[0], 1.0)
    mean = found[1:1 + size] / n
    # the largest variances come last; an axis points to its largest component
    axes = np.linalg.eigh(found[1 + size:].reshape(size, size) / n - np.outer(mean, mean))[1][:, ::-1][:, :bits]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(bits)])

    def counts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        side = (_places(classes, first, spread) - mean) @ axes > 0
        state = (side @ (1 << np.arange(bits))) % states
        token = np.repeat(state, np.diff(np.append(first, len(classes))))
        return np.bincount(token * c + classes, minlength=states * c)

    emit = gathered(counts, states * c).reshape(states, c)
    return estimate(np.zeros((2, states)), np.eye(states) * STAY, emit, lex)


def fit(ready: DataFrame, lex: Lexicon, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    model, history = starting_model(ready, lex, states), []
    for _ in range(rounds):
        model, likelihood = baum_welch_round(ready, model, lex)
        history.append(likelihood)
    return model, history


# ---------------------------------------------------------------- scoring

def forward_log10(classes: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of each whole class sequence, by the scaled forward recursion."""
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    first = (np.cumsum(lengths) - lengths)[order]
    emit, move = np.ascontiguousarray(model.emit.T), model.move
    total = np.zeros(len(lengths))
    if not len(lengths):
        return total
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right")
    now = np.repeat(model.start[:1], len(lengths), axis=0)
    # scales multiply up and are logged when they might underflow
    held = np.ones(len(lengths))
    for t, a in enumerate(active.tolist()):
        now = (now[:a] if t == 0 else now[:a] @ move) * emit[classes[first[:a] + t]]
        s = now.sum(axis=1)
        now /= s[:, None]
        held[:a] *= s
        if t % 16 == 15:
            total[:a] += np.log10(held[:a])
            held[:a] = 1.0
    total += np.log10(held)
    out = np.empty(len(lengths))
    out[order] = total
    return out


def score_chunks(ready: DataFrame, model: Model, lex: Lexicon) -> DataFrame:
    """One row per text: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    field = ready.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                classes = np.frombuffer(batch.column("classes")[i].as_py(), np.uint16)
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                inside = np.array(batch.column("inside")[i].as_py())
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), batch.column("held").slice(i, 1).flatten(), pa.array(lengths), batch.column("known").slice(i, 1).flatten(), pa.array(np.full(len(lengths), lex.tokens)), batch.column("base").slice(i, 1).flatten(), pa.array(forward_log10(classes, lengths, model) + inside)], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return ready.mapInArrow(score, f"id {field}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                          rounds: int = ROUNDS, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """The contract's columns for every text."""
    chunks = chunked(docs, id_col, text_col, held_out)
    totals = counted(chunks)
    lex = lexicon(chunks, totals)
    ready = classed(chunks, totals, lex)
    model, _ = fit(ready, lex, states, rounds)
    return score_chunks(ready, model, lex).withColumnRenamed("id", id_col)

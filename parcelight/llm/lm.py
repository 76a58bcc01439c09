"""Language-model scores: a causal self-attention model on subword ids.

Corpus statistics first: one pass over all learning documents counts their words.
From these counts come the unigram base score, the frequency of every subword, and the
classes of the model: the commonest subwords are a class each, the rest are bins of equal
mass, apart for word starts and continuations. P(subword) = P(class | context) times
P(subword | class, the word so far), the latter from the counts.

P(class | context) is one head of causal self-attention over the subwords before, on top
of a class bigram. Every learning document gives all its windows; tasks train on
their windows (numpy, Adam) and Spark averages their parameters, for a few rounds.

Scoring cuts the subwords of a text into windows of ``WINDOW`` places that overlap by
``CONTEXT``: these places are context only, so each subword is scored once, with
at least ``CONTEXT`` subwords before it (where the text has as many). Windows of many
texts go through the attention together, under a causal mask.

Counts of the ``FREQUENT`` commonest words are broadcast (a fixed number); the other
words of a document are joined with the count table by hash, so the vocabulary may
grow with the corpus. Words are told apart by XXH64. Likewise the ``PAIRS`` commonest
counts of subwords in their contexts, and of the sums they are shares of, are broadcast;
a word that needs others has its share from a join with all of them, once per word.

Defined cases: a null text is an empty one, which has the end alone; null ids are
carried; repeated rows count as rows; without learning documents every subword is
equally likely and the base score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import slices, store

WINDOW = 32
CONTEXT = 8
SCORED = WINDOW - CONTEXT
CLASSES = 64
SINGLE = 40  # classes of one subword
WIDTH = 16
OWN_VECTORS = 2048  # subwords with a vector of their own; others have their class's
FREQUENT = 1 << 18
PAIRS = 1 << 19
BACK_OFF = 5.0  # weight of the share without the subword before
ROUNDS = 3
BATCH = 128  # windows at once
RATE = 0.01
HELD = 8  # training windows to a row, of one text and one after another
AT_ONCE = 256  # such rows that a training task unfolds together
SHARD = 1 << 16  # training windows to a task
REMEMBERED = 500_000
SEED = 42


class Subwords:
    """Ids of lower-case words under a public vocabulary; two more ids mark the
    beginning and the end of a text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {
                base64.b64decode(a): int(b) for a, b in map(bytes.split, file)
            }
        self.pattern = pattern
        self.count = max(self.ranks.values()) + 1
        self.begin, self.end = self.count, self.count + 1
        self.starts_word = np.zeros(self.count + 2, dtype=bool)
        self.size = np.zeros(self.count + 2, dtype=np.int64)  # in bytes
        for token, number in self.ranks.items():
            self.starts_word[number] = token[:1] == b" "
            self.size[number] = len(token)
        self._encoding = None

    def __getstate__(self):
        return {**self.__dict__, "_encoding": None}

    def ids(self, words: bytes) -> list[int]:
        """Ids of words separated by single spaces."""
        if self._encoding is None:
            import tiktoken

            self._encoding = tiktoken.Encoding(
                "words", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}
            )
        return self._encoding.encode_ordinary(" " + words.decode())

    def of_words(self, words: list[bytes], at_once: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has. Words are
        cut apart at white space, so they are encoded as one text; ids that
        start with a space mark the borders, and lengths must agree."""
        flat, sizes = [], []
        for at in range(0, len(words), at_once):
            part = words[at : at + at_once]
            lengths = np.array([len(w) for w in part])
            count = np.zeros(len(part), dtype=np.int64)
            full = [w for w in part if w]
            ids = np.array(self.ids(b" ".join(full)) if full else [], dtype=np.int64)
            starts = np.flatnonzero(self.starts_word[ids])
            if len(starts) == len(full) and (
                not full
                or (np.add.reduceat(self.size[ids], starts) == lengths[lengths > 0] + 1).all()
            ):
                count[lengths > 0] = np.diff(np.r_[starts, len(ids)])
            else:  # a word with white space of its own kind
                each = [self.ids(w) if w else [] for w in part]
                ids = np.array([i for e in each for i in e], dtype=np.int64)
                count = np.array([len(e) for e in each])
            flat.append(ids)
            sizes.append(count)
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *flat]), np.concatenate([none, *sizes])


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of several texts, the places of all words among them, and
    how many each text has: A-Z lowered, cut at ``[\\x20\\x09-\\x0D]+``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    index = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    blank = np.array([not w for w in words], dtype=bool)  # before or after all words
    if blank.any():
        kept = ~blank[index]
        index, owner = index[kept], owner[kept]
    return words, index, np.bincount(owner, minlength=len(texts))


def contexts_of(ids: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """For the ids of words, one after another: the id before, and a number for
    all ids before where there are two or more; -1 for none."""
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(ids)) - np.repeat(first, sizes)
    before = np.where(place > 0, np.r_[-1, ids[:-1]][: len(ids)], -1)
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(np.bincount(place)) if len(ids) else []
    mixed = np.zeros(len(ids), dtype=np.uint64)
    prefix = np.full(len(ids), -1, dtype=np.int64)
    for nth in range(1, len(ends)):
        at = order[ends[nth - 1] : ends[nth]]
        mixed[at] = (mixed[at - 1] + ids[at - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(
            0x9E3779B97F4A7C15
        )
        if nth > 1:
            prefix[at] = 1 << 30 | (mixed[at] >> np.uint64(34)).astype(np.int64)
    return [before, prefix]


# -- classes -------------------------------------------------------------------
@dataclass
class Classes:
    of: np.ndarray  # class of each id
    row: np.ndarray  # vector of each id
    log_share: np.ndarray  # log10 P(id | class)


def classes_of(subwords: Subwords, counts: np.ndarray) -> Classes:
    """``counts`` of all ids, the end among them. The beginning is never
    predicted and shares the end's class as an input only."""
    predicted = np.r_[0 : subwords.count, subwords.end]
    order = predicted[np.lexsort((predicted, -counts[predicted]))]
    single = np.r_[subwords.end, order[order != subwords.end][: SINGLE - 1]]
    of = np.full(subwords.count + 2, -1, dtype=np.int64)
    of[single] = np.arange(len(single))
    rest = order[of[order] < 0]
    bins = (CLASSES - SINGLE) // 2
    for k, members in enumerate(
        (rest[subwords.starts_word[rest]], rest[~subwords.starts_word[rest]])
    ):
        mass = np.cumsum(counts[members] + 0.5)
        at = np.minimum((mass / mass[-1] * bins).astype(np.int64), bins - 1) if len(mass) else mass
        of[members] = SINGLE + k * bins + at
    weight = counts.astype(float) + 0.5
    weight[subwords.begin] = 0
    whole = np.bincount(np.maximum(of, 0), weights=weight, minlength=CLASSES)
    of[subwords.begin] = of[subwords.end]
    with np.errstate(divide="ignore"):
        log_share = np.log10(weight / whole[of])
    row = OWN_VECTORS + of
    row[order[:OWN_VECTORS]] = np.arange(min(OWN_VECTORS, len(order)))
    row[subwords.begin] = OWN_VECTORS + CLASSES
    return Classes(of, row, log_share)


@dataclass
class Pairs:
    """Counts of ids in a context within a word, by sorted key."""

    keys: np.ndarray  # context << 32 | id
    counts: np.ndarray
    every: DataFrame | None = None  # (key, n) of all, if these are the commonest only

    def within(self, classes: Classes) -> PairShares:
        """Sums per left id and class of the right id, for the shares."""
        if self.every is not None:
            return self._within_every(classes)
        groups, sums = _class_sums(self.keys, self.counts, classes)
        return PairShares(self.keys, self.counts, groups, sums)

    def _within_every(self, classes: Classes) -> PairShares:
        sent = self.every.sparkSession.sparkContext.broadcast(classes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                groups, sums = _class_sums(
                    batch.column(0).to_numpy(), batch.column(1).to_numpy(), sent.value
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(-1 - groups), pa.array(sums.astype(np.int64))], ["key", "n"]
                )

        sums, _ = store(
            self.every.mapInArrow(run, "key long, n long").groupBy("key")
            .agg(F.sum("n").alias("n")),
            "lm-sums",
        )
        common = commonest(sums, PAIRS).toArrow()
        groups = -1 - common["key"].to_numpy()
        order = np.argsort(groups)
        return PairShares(
            self.keys, self.counts, groups[order], common["n"].to_numpy()[order],
            True, self.every.unionByName(sums),
        )


def _class_sums(keys: np.ndarray, counts: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    group = (keys >> 32) * CLASSES + classes.of[keys & 0xFFFFFFFF]
    groups, member = np.unique(group, return_inverse=True)
    return groups, np.bincount(member, weights=counts, minlength=len(groups))


@dataclass
class PairShares:
    keys: np.ndarray
    counts: np.ndarray
    groups: np.ndarray
    sums: np.ndarray  # whole sums, also where keys are the commonest only
    cut: bool = False
    every: DataFrame | None = None  # (key or -1 - group, n) of all, if cut

    def __getstate__(self):
        return {**self.__dict__, "every": None}

    @staticmethod
    def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    @staticmethod
    def _wanted(
        classes: Classes, right: np.ndarray, left: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        key = np.where(left >= 0, left << 32 | right, -1)
        group = np.where(left >= 0, left * CLASSES + classes.of[right], -1)
        return key, group

    def missing(
        self, classes: Classes, right: np.ndarray, contexts: list[np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """What :meth:`log_share` needs and the cut tables lack: where its answer
        goes (row-major in ``answers``), and its key in ``every``."""
        at, wanted = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for nth, left in enumerate(contexts):
            key, group = self._wanted(classes, right, left)
            for k, (table, values, name) in enumerate(
                ((self.keys, key, key), (self.groups, group, -1 - group))
            ):
                one = np.ones(len(table), dtype=np.int64)
                lacks = np.flatnonzero((left >= 0) & (self._looked_up(table, one, values) == 0))
                at.append(lacks * 2 * len(contexts) + 2 * nth + k)
                wanted.append(name[lacks])
        return np.concatenate(at), np.concatenate(wanted)

    def log_share(
        self, classes: Classes, right: np.ndarray, contexts: list[np.ndarray],
        answers: np.ndarray | None = None,
    ) -> np.ndarray:
        """log10 P(right | its class, contexts), each context backing off to the
        ones before it; -1 where there is none. ``answers``: count and sum per
        context, where the tables have none."""
        share = 10.0 ** classes.log_share[right]
        for nth, left in enumerate(contexts):
            key, group = self._wanted(classes, right, left)
            n = self._looked_up(self.keys, self.counts, key)
            whole = self._looked_up(self.groups, self.sums, group)
            if answers is not None:
                n = n + answers[:, 2 * nth]
                whole = whole + answers[:, 2 * nth + 1]
            share = np.where(left >= 0, (n + BACK_OFF * share) / (whole + BACK_OFF), share)
        return np.log10(share)


# -- windows -------------------------------------------------------------------
def windows_of(ids: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (n, WINDOW) and targets (n, SCORED) of one text, -1 where there is
    none. Window k scores the targets SCORED * k and following."""
    n = len(ids) // SCORED + 1
    inputs = np.full(n * SCORED + CONTEXT, -1, dtype=np.int32)
    inputs[CONTEXT] = begin
    inputs[CONTEXT + 1 : CONTEXT + 1 + len(ids)] = ids[: len(inputs) - CONTEXT - 1]
    targets = np.full(n * SCORED, -1, dtype=np.int32)
    targets[: len(ids)] = ids
    targets[len(ids)] = end
    cut = inputs[(np.arange(n) * SCORED)[:, None] + np.arange(WINDOW)]
    return cut, targets.reshape(n, SCORED)


def folded(ids: np.ndarray, begin: int, end: int) -> list[np.ndarray]:
    """The windows of :func:`windows_of`, up to HELD to a row, each subword once: the
    context, the scored places and the target that follows. -1 stands for none."""
    n = len(ids) // SCORED + 1
    whole = np.full(n * SCORED + CONTEXT + 1, -1, dtype=np.int32)
    whole[CONTEXT] = begin
    whole[CONTEXT + 1 : CONTEXT + 1 + len(ids)] = ids
    whole[CONTEXT + 1 + len(ids)] = end
    return [
        whole[k * SCORED : min(k + HELD, n) * SCORED + CONTEXT + 1] for k in range(0, n, HELD)
    ]


def unfolded(rows: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of all windows of such rows."""
    flat = rows.flatten().to_numpy().astype(np.int64)
    sizes = pc.list_value_length(rows).to_numpy()
    windows = (sizes - CONTEXT - 1) // SCORED
    nth = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    start = (np.repeat(np.cumsum(sizes) - sizes, windows) + nth * SCORED)[:, None]
    inputs = flat[start + np.arange(WINDOW)]
    return np.where(inputs == end, -1, inputs), flat[start + np.arange(CONTEXT + 1, WINDOW + 1)]


# -- the model -----------------------------------------------------------------
SHAPES = {
    "vectors": (OWN_VECTORS + CLASSES + 2, WIDTH),  # the last row stands for -1
    "places": (WINDOW, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "mixed": (WIDTH, WIDTH),
    "output": (WIDTH, CLASSES),
    "bigram": (CLASSES, CLASSES),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
_causal = (
    np.arange(WINDOW)[None, :] <= np.arange(CONTEXT, WINDOW)[:, None]
).astype(np.float32)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def first_parameters(bigrams: np.ndarray) -> np.ndarray:
    """Small random vectors, and the log of the class bigrams counted in all
    training windows."""
    rng = np.random.default_rng(SEED)
    flat = (rng.normal(size=SIZE) * 0.1).astype(np.float32)
    p = unpacked(flat)
    p["output"][:] = 0
    counts = bigrams.reshape(CLASSES, CLASSES) + 0.0
    alone = counts.sum(axis=0) + 0.1
    mixed = counts + 5.0 * alone / alone.sum()
    p["bigram"][:] = np.log(mixed / mixed.sum(axis=1, keepdims=True))
    return flat


class Room:
    """Arrays that every batch uses again: fresh memory for them costs as much time as
    what is computed in them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, like: np.ndarray, *shape: int) -> np.ndarray:
        """An array of this shape and the type of ``like``, with any content; the next
        call by the same name gives the same memory."""
        size = math.prod(shape)
        held = self.held.get(name)
        if held is None or held.size < size or held.dtype != like.dtype:
            held = self.held[name] = np.empty(size, dtype=like.dtype)
        return held[:size].reshape(shape)


def attention(
    p: dict[str, np.ndarray], x: np.ndarray, present: np.ndarray, normal: bool = True,
    room: Room | None = None,
):
    """Hidden states of the scored places, with what a backward pass needs (it
    needs ``normal`` weights), in arrays of ``room``.
    ``x``: vector rows (n, WINDOW); ``present``: places that hold a subword."""
    n = len(x)
    room, like = room or Room(), p["vectors"]
    inputs = np.take(like, x, axis=0, out=room("inputs", like, n, WINDOW, WIDTH), mode="clip")
    inputs += p["places"]
    flat = inputs.reshape(-1, WIDTH)
    key = np.matmul(flat, p["key"], out=room("key", like, n * WINDOW, WIDTH))
    key = key.reshape(n, WINDOW, WIDTH)
    # The sum of the weights as one more value.
    value = room("value", like, n, WINDOW, WIDTH + 1)
    np.matmul(flat, p["value"], out=value.reshape(-1, WIDTH + 1)[:, :-1])
    value[..., -1] = 1
    own = room("own", like, n * SCORED, WIDTH)
    own.reshape(n, SCORED, WIDTH)[:] = inputs[:, CONTEXT:]
    query = np.matmul(own, p["query"], out=room("query", like, n * SCORED, WIDTH))
    query *= np.float32(WIDTH**-0.5)
    query = query.reshape(n, SCORED, WIDTH)
    weight = np.matmul(query, key.transpose(0, 2, 1), out=room("weight", like, n, SCORED, WINDOW))
    if weight.max(initial=0) > 60:
        np.minimum(weight, 60, out=weight)
    np.exp(weight, out=weight)
    weight *= _causal
    lacking = np.flatnonzero(~present.all(axis=1))
    if len(lacking):
        weight[lacking] *= present[lacking, None, :]
    summed = np.matmul(weight, value, out=room("summed", like, n, SCORED, WIDTH + 1))
    total = summed[..., -1:] + np.float32(1e-20)
    seen = np.divide(summed[..., :-1], total, out=room("seen", like, n, SCORED, WIDTH))
    if normal:
        weight /= total
    hidden = np.matmul(
        seen.reshape(-1, WIDTH), p["mixed"], out=room("hidden", like, n * SCORED, WIDTH)
    )
    hidden += own
    return inputs, key, value, query, weight, seen, hidden.reshape(n, SCORED, WIDTH)


def _row_maxima(values: np.ndarray, room: Room) -> np.ndarray:
    """The largest number of each row, by halves: numpy takes rows of few numbers slowly."""
    n, size = values.shape
    while size > 1:
        size //= 2
        values = np.maximum(
            values[:, :size], values[:, size:], out=room(f"half {size}", values, n, size)
        )
    return values


def _logits(
    p: dict[str, np.ndarray], hidden: np.ndarray, previous: np.ndarray, room: Room
) -> np.ndarray:
    like, flat = p["output"], hidden.reshape(-1, WIDTH)
    logits = np.matmul(flat, like, out=room("logits", like, len(flat), CLASSES))
    before = room("before", like, len(flat), CLASSES)
    logits += np.take(p["bigram"], previous.ravel(), axis=0, out=before, mode="clip")
    return logits


def log_probabilities(
    p: dict[str, np.ndarray], x: np.ndarray, present: np.ndarray,
    previous: np.ndarray, target: np.ndarray, room: Room | None = None,
) -> np.ndarray:
    """Natural log P(target class) of every scored place."""
    room = room or Room()
    logits = _logits(p, attention(p, x, present, False, room)[-1], previous, room)
    chosen = logits[np.arange(len(logits)), target.ravel()].astype(np.float64)
    if logits.max(initial=0) > 80:
        np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    return (chosen - np.log(logits.sum(axis=1, dtype=np.float64))).reshape(target.shape)


def gradients(
    p: dict[str, np.ndarray], x: np.ndarray, present: np.ndarray,
    previous: np.ndarray, target: np.ndarray, scored: np.ndarray, room: Room | None = None,
) -> dict[str, np.ndarray]:
    """Of the mean negative log probability over the ``scored`` places."""
    n = len(x)
    room, like = room or Room(), p["vectors"]
    inputs, key, value, query, weight, seen, hidden = attention(p, x, present, room=room)
    flat = hidden.reshape(-1, WIDTH)
    d_logits = _logits(p, hidden, previous, room)
    d_logits -= _row_maxima(d_logits, room)
    np.exp(d_logits, out=d_logits)
    d_logits /= d_logits.sum(axis=1, keepdims=True)
    d_logits[np.arange(len(d_logits)), target.ravel()] -= 1
    d_logits *= scored.reshape(-1, 1) / max(1, scored.sum())
    out = {"output": flat.T @ d_logits}
    is_previous = room("is_previous", like, CLASSES, len(d_logits))
    is_previous.fill(0)
    is_previous[previous.ravel(), np.arange(len(d_logits))] = 1
    out["bigram"] = is_previous @ d_logits
    d_hidden = np.matmul(d_logits, p["output"].T, out=room("d_hidden", like, n * SCORED, WIDTH))
    out["mixed"] = seen.reshape(-1, WIDTH).T @ d_hidden
    d_seen = np.matmul(d_hidden, p["mixed"].T, out=room("d_seen", like, n * SCORED, WIDTH))
    d_seen = d_seen.reshape(n, SCORED, WIDTH)
    d_value = np.matmul(weight.transpose(0, 2, 1), d_seen, out=room("d_value", like, n, WINDOW, WIDTH))
    d_weight = np.matmul(
        d_seen, value[..., :-1].transpose(0, 2, 1), out=room("d_weight", like, n, SCORED, WINDOW)
    )
    product = np.multiply(d_weight, weight, out=room("product", like, n, SCORED, WINDOW))
    d_weight -= product.sum(axis=-1, keepdims=True)
    d_weight *= weight
    d_key = np.matmul(d_weight.transpose(0, 2, 1), query, out=room("d_key", like, n, WINDOW, WIDTH))
    d_query = np.matmul(d_weight, key, out=room("d_query", like, n, SCORED, WIDTH))
    d_query *= np.float32(WIDTH**-0.5)
    every = inputs.reshape(-1, WIDTH)
    own = room("own", like, n * SCORED, WIDTH)  # as attention() left it
    d_key, d_value, d_query = (d.reshape(-1, WIDTH) for d in (d_key, d_value, d_query))
    out["key"] = every.T @ d_key
    out["value"] = every.T @ d_value
    out["query"] = own.T @ d_query
    d_flat = np.matmul(d_key, p["key"].T, out=room("d_flat", like, n * WINDOW, WIDTH))
    d_flat += np.matmul(d_value, p["value"].T, out=room("d_more", like, n * WINDOW, WIDTH))
    d_inputs = d_flat.reshape(n, WINDOW, WIDTH)
    d_inputs[:, CONTEXT:] += d_hidden.reshape(n, SCORED, WIDTH)
    d_own = np.matmul(d_query, p["query"].T, out=room("d_own", like, n * SCORED, WIDTH))
    d_inputs[:, CONTEXT:] += d_own.reshape(n, SCORED, WIDTH)
    out["places"] = d_inputs.sum(axis=0)
    out["vectors"] = _summed_rows(x.ravel(), d_flat, len(like), room)
    return out


def _summed_rows(at: np.ndarray, rows: np.ndarray, size: int, room: Room) -> np.ndarray:
    """``rows`` added up by their places ``at``, in order, number by number: numpy is
    several times as fast with flat places as with those of rows."""
    out = np.zeros((size, rows.shape[1]), dtype=rows.dtype)
    flat = room("places", at, *rows.shape)
    np.add((at * rows.shape[1])[:, None], np.arange(rows.shape[1]), out=flat)
    np.add.at(out.reshape(-1), flat.reshape(-1), rows.reshape(-1))
    return out


def _prepared(classes: Classes, inputs: np.ndarray, targets: np.ndarray):
    """Rows, presence, previous class, target class and scored places."""
    rows = np.where(inputs >= 0, classes.row[inputs], SHAPES["vectors"][0] - 1)
    before = inputs[:, CONTEXT:]
    previous = classes.of[np.maximum(before, 0)]
    return rows, inputs >= 0, previous, classes.of[np.maximum(targets, 0)], targets >= 0


def trained(
    flat: np.ndarray, classes: Classes, parts: Iterator[tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, int]:
    """Parameters after one pass of Adam over the windows, and how many these are."""
    flat = flat.astype(np.float32).copy()
    p = unpacked(flat)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    room, change, gradient = Room(), np.empty_like(flat), np.empty_like(flat)
    step, seen = 0, 0
    for inputs, targets in parts:
        seen += len(inputs)
        for at in range(0, len(inputs), BATCH):
            found = gradients(
                p, *_prepared(classes, inputs[at : at + BATCH], targets[at : at + BATCH]), room
            )
            np.concatenate([found[name].ravel() for name in SHAPES], out=gradient)
            step += 1
            np.subtract(gradient, first, out=change)
            change *= 0.1
            first += change
            np.multiply(gradient, gradient, out=change)
            change -= second
            change *= 0.01
            second += change
            scale = np.divide(second, 1 - 0.99**step, out=gradient)
            np.sqrt(scale, out=scale)
            scale += np.float32(1e-6)
            np.divide(first, 1 - 0.9**step, out=change)
            change *= RATE
            change /= scale
            flat -= change
    return flat, seen


# -- corpus statistics ---------------------------------------------------------
def corpus(docs: DataFrame, subwords: Subwords, text: str) -> tuple[DataFrame, DataFrame]:
    """(word, n) over all documents, the end of a text being the empty word; and
    all training windows of each document, :func:`folded`."""
    sent = docs.sparkSession.sparkContext.broadcast(subwords)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows(words, counts, windows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(windows, pa.list_(pa.int32())),
                ],
                ["word", "n", "window"],
            )

        for batch in slices(batches, text):
            words, index, sizes = split_words(batch.column(text))
            counts = np.bincount(index, minlength=len(words)).tolist()
            seen.update({w: n for w, n in zip(words, counts) if n})
            seen[b""] += len(sizes)
            ids, each = sent.value.of_words(words)
            first = np.cumsum(each) - each
            windows, end = [], 0
            for size in sizes.tolist():
                own = index[end : end + size]
                end += size
                many = each[own]
                before = np.cumsum(many) - many
                at = np.repeat(first[own] - before, many) + np.arange(int(many.sum()))
                windows += folded(ids[at], sent.value.begin, sent.value.end)
            yield rows([None] * len(windows), [None] * len(windows), windows)
            if len(seen) > REMEMBERED:
                yield rows(list(seen), list(seen.values()), [None] * len(seen))
                seen.clear()
        yield rows(list(seen), list(seen.values()), [None] * len(seen))

    raw, _ = store(
        docs.select(text).mapInArrow(run, "word binary, n long, window array<int>"), "lm-raw"
    )
    counts, _ = store(
        raw.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
        .withColumn("hash", F.xxhash64(F.col("word"))),
        "lm-words",
    )
    return counts, raw.where("window IS NOT NULL").select("window")


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """The rows whose ``n`` reaches the lowest bound that at most ``most`` rows
    reach. Bounds are sixteenths of powers of two, so that a thousand counts
    decide and nothing is sorted."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    room, least = most, None
    for row in sorted(sizes, key=lambda r: -r.step):
        room -= row.rows
        if room < 0:
            break
        least = row.step
    return counts.where(step >= least if least is not None else F.lit(False))


def subword_counts(
    counts: DataFrame, subwords: Subwords
) -> tuple[np.ndarray, Pairs]:
    """How often each id occurs, and each id in its contexts in a word, from the
    counts of words: exact over the corpus, at one look per distinct word. Of the
    pairs the :data:`PAIRS` commonest are collected, the others stay in a table."""
    sent = counts.sparkSession.sparkContext.broadcast(subwords)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(sent.value.count + 2)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(keys, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["key", "n"]
            )

        def summed_pairs() -> pa.RecordBatch:
            keys, member = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            weights = np.concatenate([h[1] for h in held])
            held.clear()
            return rows(keys, np.bincount(member, weights=weights).astype(np.int64))

        for batch in batches:
            words = batch.column(0).to_pylist()
            n = batch.column(1).to_numpy()
            found[sent.value.end] += sum(c for w, c in zip(words, n.tolist()) if not w)
            ids, sizes = sent.value.of_words(words)
            each = np.repeat(n, sizes)
            found += np.bincount(ids, weights=each, minlength=len(found))
            for left in contexts_of(ids, sizes):
                after = left >= 0
                held.append((left[after] << 32 | ids[after], each[after]))
            if sum(len(h[0]) for h in held) > 4 * REMEMBERED:
                yield summed_pairs()
        used = np.flatnonzero(found)
        yield rows(-1 - used, found[used].astype(np.int64))
        if held:
            yield summed_pairs()

    summed, _ = store(
        counts.select("word", "n").mapInArrow(run, "key long, n long").groupBy("key")
        .agg(F.sum("n").alias("n")),
        "lm-subwords",
    )
    alone = summed.where("key < 0").toArrow()  # at most one row per subword
    out = np.zeros(subwords.count + 2, dtype=np.int64)
    out[-1 - alone["key"].to_numpy()] = alone["n"].to_numpy()
    every = summed.where("key >= 0")
    common = commonest(every, PAIRS).toArrow()
    order = np.argsort(common["key"].to_numpy())
    cut = every.count() > len(order)
    return out, Pairs(
        common["key"].to_numpy()[order], common["n"].to_numpy()[order], every if cut else None
    )


def _window_arrays(
    batches: Iterator[pa.RecordBatch], end: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield unfolded(batch.column(0).slice(at, AT_ONCE), end)


def fit(windows: DataFrame, classes: Classes, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters, averaged over tasks after each pass over all windows."""
    spark = windows.sparkSession
    sent_classes = spark.sparkContext.broadcast(classes)
    end = len(classes.of) - 1

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CLASSES * CLASSES)
        for part in _window_arrays(batches, end):
            _, _, previous, target, scored = _prepared(sent_classes.value, *part)
            pairs = (previous * CLASSES + target)[scored]
            found += np.bincount(pairs, minlength=len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["i", "v"]
        )

    def summed(run, frame: DataFrame, size: int) -> np.ndarray:
        rows = (
            frame.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
            .toArrow()  # one row per parameter
        )
        out = np.zeros(size)
        out[rows["i"].to_numpy()] = rows["v"].to_numpy()
        return out

    flat = first_parameters(summed(bigrams, windows, CLASSES * CLASSES))
    held = (F.size("window") - F.lit(CONTEXT + 1)) / F.lit(SCORED)
    many = int(windows.agg(F.sum(held)).first()[0] or 0)
    shards = max(1, -(-many // SHARD))
    dealt, _ = store(windows.repartition(shards), "lm-shards")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(flat)

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, seen = trained(sent.value, sent_classes.value, _window_arrays(batches, end))
            if seen:
                weighted = np.r_[own.astype(np.float64) * seen, seen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(SIZE + 1, dtype=np.int32)), pa.array(weighted)],
                    ["i", "v"],
                )

        total = summed(train, dealt, SIZE + 1)
        if total[-1]:
            flat = (total[:-1] / total[-1]).astype(np.float32)
    return flat


# -- scoring -------------------------------------------------------------------
@dataclass
class Model:
    subwords: Subwords
    classes: Classes
    pairs: PairShares
    parameters: np.ndarray
    hashes: np.ndarray  # of the frequent words, sorted
    counts: np.ndarray
    ends: int  # texts learnt from


class WordTable:
    """What a worker knows of words: subword ids, and the count if it was sent."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.place.clear()
        self.ids = np.zeros(0, dtype=np.int32)
        self.size = np.zeros(0, dtype=np.int64)
        self.first = np.zeros(0, dtype=np.int64)
        self.hash = np.zeros(0, dtype=np.uint64)
        self.count = np.zeros(0, dtype=np.int64)  # -1: not among the frequent
        self.share = np.zeros(0)  # log10 P(subwords | their classes)
        self.open = np.zeros(0, dtype=bool)  # the share needs more than was sent
        self.fresh: list[tuple[int, bytes]] = []  # open words not told of yet

    def places(self, words: list[bytes]) -> np.ndarray:
        """Rows of the words, which are distinct; new ones are added, and the open
        ones of them are in ``fresh``."""
        self.fresh = []
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self._clear()
            new = words
        if new:
            self._add(new)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def _add(self, new: list[bytes]) -> None:
        ids, sizes = self.model.subwords.of_words(new)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in new), np.uint64, len(new))
        counts = np.full(len(new), -1, dtype=np.int64)
        if len(self.model.hashes):
            at = np.minimum(np.searchsorted(self.model.hashes, hashes), len(self.model.hashes) - 1)
            hit = self.model.hashes[at] == hashes
            counts[hit] = self.model.counts[at[hit]]
        contexts = contexts_of(ids, sizes)
        shares = self.model.pairs.log_share(self.model.classes, ids, contexts)
        owner = np.repeat(np.arange(len(new)), sizes)
        unsettled = np.zeros(len(new), dtype=bool)
        if self.model.pairs.cut:
            at, _ = self.model.pairs.missing(self.model.classes, ids, contexts)
            unsettled[owner[at // (2 * len(contexts))]] = True
            signed = hashes.view(np.int64)
            self.fresh += [(int(signed[i]), new[i]) for i in np.flatnonzero(unsettled)]
        self.open = np.r_[self.open, unsettled]
        begin = len(self.size)
        self.place.update(zip(new, range(begin, begin + len(new))))
        self.first = np.r_[self.first, len(self.ids) + np.cumsum(sizes) - sizes]
        self.share = np.r_[self.share, np.bincount(owner, weights=shares, minlength=len(new))]
        self.ids = np.r_[self.ids, ids.astype(np.int32)]
        self.size = np.r_[self.size, sizes]
        self.hash = np.r_[self.hash, hashes]
        self.count = np.r_[self.count, counts]

    def subword_ids(self, at: np.ndarray) -> np.ndarray:
        """Ids of the words in these rows, one after another."""
        sizes = self.size[at]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.first[at] - before, sizes) + np.arange(int(sizes.sum()))]


def _class_scores(model: Model, windows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of the classes of each text."""
    inputs = np.concatenate([w[0] for w in windows])
    targets = np.concatenate([w[1] for w in windows])
    owner = np.repeat(np.arange(len(windows)), [len(w[0]) for w in windows])
    total = np.zeros(len(inputs))
    p = unpacked(model.parameters)
    room = Room()
    for at in range(0, len(inputs), BATCH):
        own = slice(at, at + BATCH)
        rows, present, previous, target, scored = _prepared(
            model.classes, inputs[own], targets[own]
        )
        found = log_probabilities(p, rows, present, previous, target, room)
        total[own] = (found * scored).sum(axis=1) / np.log(10)
    return np.bincount(owner, weights=total, minlength=len(windows))


def open_shares(words: DataFrame, model: Broadcast, every: DataFrame) -> DataFrame:
    """(hash, share) of distinct words (hash, word): log10 P(subwords | their
    classes). What the tables sent lack is joined with ``every``."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            ids, sizes = own.subwords.of_words(batch.column(1).to_pylist())
            contexts = contexts_of(ids, sizes)
            at, key = own.pairs.missing(own.classes, ids, contexts)
            each = 2 * len(contexts)
            owner = np.repeat(np.arange(len(sizes)), sizes)[at // each]
            at -= (np.cumsum(sizes) - sizes)[owner] * each
            hashes = batch.column(0).to_numpy()[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(at), pa.array(key)], ["hash", "at", "key"]
            )

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            ids, sizes = own.subwords.of_words(batch.column(1).to_pylist())
            contexts = contexts_of(ids, sizes)
            each = 2 * len(contexts)
            answers = np.zeros(len(ids) * each)
            given = batch.column(2)
            found = given.flatten()
            owner = np.repeat(
                np.arange(len(sizes)), pc.fill_null(pc.list_value_length(given), 0).to_numpy()
            )
            first = (np.cumsum(sizes) - sizes) * each
            answers[first[owner] + found.field("at").to_numpy()] = found.field("n").to_numpy()
            logs = own.pairs.log_share(own.classes, ids, contexts, answers.reshape(-1, each))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.bincount(owner, weights=logs, minlength=len(sizes)))],
                ["hash", "share"],
            )

    answers = (
        words.mapInArrow(asked, "hash long, at long, key long").join(every, "key")
        .groupBy("hash").agg(F.collect_list(F.struct("at", "n")).alias("answers"))
    )
    return words.join(answers, "hash", "left").select("hash", "word", "answers").mapInArrow(
        shares, "hash long, share double"
    )


def score(
    docs: DataFrame, learning: DataFrame, path: str, pattern: str,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs``; statistics and model come from ``learning``. ``path`` and
    ``pattern`` name a rank file and its way of cutting text."""
    spark = docs.sparkSession
    subwords = Subwords(path, pattern)
    given = learning.select(F.col(text).alias("_text"))
    counts, windows = corpus(given, subwords, "_text")
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = whole.n or 0, whole.v
    alone, pairs = subword_counts(counts, subwords)
    classes = classes_of(subwords, alone)
    frequent = commonest(counts.select("hash", "n"), FREQUENT).toArrow()
    hashes = frequent["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    shares = pairs.within(classes)
    model = Model(
        subwords, classes, shares, fit(windows, classes), hashes[order],
        frequent["n"].to_numpy()[order], int(alone[subwords.end]),
    )
    sent = spark.sparkContext.broadcast(model)
    schema = (
        f"_id {dict(docs.dtypes)[id_column]}, n_tokens long, n_known long, base double, "
        "score double, rare array<struct<hash:long,times:long,open:long>>, "
        "fresh array<struct<hash:long,word:binary>>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(sent.value)
        own = sent.value
        for batch in slices(batches, "_text"):
            words, index, lengths = split_words(batch.column("_text"))
            places = known.places(words)[index]
            fresh = [{"hash": h, "word": w} for h, w in known.fresh]
            sizes, found, base, cut, rare, shares = [], [], [], [], [], []
            stop = 0
            for length in lengths.tolist():
                at = places[stop : stop + length]
                stop += length
                c = known.count[at]
                common = c >= 0
                sizes.append(length + 1)
                found.append(int((c > 0).sum()) + int(own.ends > 0))
                base.append(float(np.log10(c[common] + 0.5).sum() + np.log10(own.ends + 0.5)))
                unsettled = known.open[at]
                later = ~common | unsettled
                other, member = np.unique(known.hash[at[later]], return_inverse=True)
                rare.append((
                    other.view(np.int64),
                    np.bincount(member, ~common[later], len(other)).astype(np.int64),
                    np.bincount(member, unsettled[later], len(other)).astype(np.int64),
                ))
                shares.append(float(known.share[at[~unsettled]].sum()))
                ids = known.subword_ids(at)
                cut.append(windows_of(ids, own.subwords.begin, own.subwords.end))
            offsets = np.r_[0, np.cumsum([len(r[0]) for r in rare])].astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([r[0] for r in rare])),
                 pa.array(np.concatenate([r[1] for r in rare])),
                 pa.array(np.concatenate([r[2] for r in rare]))],
                ["hash", "times", "open"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array(sizes, pa.int64()),
                    pa.array(found, pa.int64()), pa.array(base, pa.float64()),
                    pa.array(_class_scores(own, cut) + np.array(shares)),
                    pa.ListArray.from_arrays(pa.array(offsets), entries),
                    # New open words go with the first text they are met in.
                    pa.array(
                        [fresh] + [[]] * (len(sizes) - 1),
                        pa.list_(pa.struct([("hash", pa.int64()), ("word", pa.binary())])),
                    ),
                ],
                names=["_id", "n_tokens", "n_known", "base", "score", "rare", "fresh"],
            )

    rows, _ = store(
        docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
        .mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()),
        "lm-scores",
    )
    words = counts.select("hash", "n")
    if shares.cut:
        opened, _ = store(
            rows.select(F.inline("fresh")).dropDuplicates(["hash"]).select("hash", "word"), "lm-open"
        )
        words = words.join(open_shares(opened, sent, shares.every), "hash", "full")
    else:
        words = words.withColumn("share", F.lit(0.0))
    rest = (
        rows.select("_row", F.inline("rare"))
        .join(words, "hash", "left").groupBy("_row").agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_base"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(F.lit(0))).alias("_known"),
            F.sum(F.col("open") * F.coalesce("share", F.lit(0.0))).alias("_share"),
        )
    )
    each = float(np.log10(tokens + 0.5 * (distinct + 1)))
    return (
        rows.drop("rare", "fresh").join(rest, "_row", "left")
        .select(
            F.col("_id").alias(id_column), "n_tokens",
            (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(each))
            .alias("base_score"),
            F.round(F.col("score") + F.coalesce("_share", F.lit(0.0)), 6).alias("score"),
        )
    )

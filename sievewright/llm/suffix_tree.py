"""LM scoring with a probabilistic suffix tree over words.

The root has Good-Turing estimates: the V known words share 1 - u of the mass by their
counts, and V + 1 words that may still come share u, the part of the tokens whose word
occurs once, so the root adds up to one over an open vocabulary. A context s (some words
before a token, within its text) is looked at if it occurs ``least`` times, its suffix, one
word shorter, is a state, and what stands before its last word was looked at. It keeps the
next words w whose counts diverge from what the suffix s' predicts,

    c(s,w) >= least and c(s,w) * log(c(s,w) / (c(s) * P(w|s'))) >= divergence,

(the expectation's binary logarithm rounded to 1/8 where s occurs less than 16 times, and to
1/8 divided by c(s)/16 or more beyond, so that rounding moves the left side by 0.7 at most) and is a state if it keeps any. What it
does not keep is predicted by its suffix; with R(s) the count of the words it keeps,

    P(w|s) = [w kept] c(s,w) / (c(s) + pull) + (1 - R(s) / (c(s) + pull)) * P(w|s'),

which adds up to one. The tree deepens until no context keeps anything; a token is predicted
by the longest suffix of what stands before it that is a state. A word is counted after a
context if it occurs ``least`` times after the suffix, as it cannot be kept or lead on otherwise.

No part of the tree is broadcast or collected. Texts are coded into blocks of tokens; each
level is one exchange between blocks and buckets of contexts. Words and contexts have
numbers that their bucket gives them, so counts are exact (words are told apart by 64 bits
of hash). A frequent context is dealt into shards of its next words, so that it never
meets in one task. The first ``UNROLLED`` levels, which most tokens reach, are one job over one
exchange of the blocks; each deeper level is a job over the few tokens that reach it.

Within that job a rarer context stays in the bucket that counted it as a pair one level before.
Its number is not sent: a block names it by its place among the pairs that it sent there and
that lead on, and the bucket, which reads what it was sent on the levels before as well, knows
which pair that is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import chunked
from sievewright.llm import textbytes as tb
from sievewright.llm.staging import staged

DIVERGENCE, LEAST, PULL = 10.0, 2, 1.0
BLOCK, SHARD, UNROLLED = 3 << 19, 4096, 4
WORDS = 0  # the kind of the root's answers; the others are levels
END = np.uint64(0x5851F42D4C957F2D)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEPS, ZERO = 8, 1 << 13  # of the expectation's logarithm, and what stands for 0; both times a scale that grows with the context
TOKENS = "block bigint, ids array<bigint>, sizes array<bigint>, words binary, classes binary, tokens binary"
DOCS = ["ids", "n_tokens", "n_known", "base", "score"]
STATE = "block bigint, ids array<bigint>, n_tokens array<bigint>, n_known array<bigint>, base array<double>, score array<double>, active bigint, arrays binary"
RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


@dataclass(frozen=True)
class Corpus:
    """The parameters, and the numbers of the training tokens."""

    mod: int
    held: int
    buckets: int
    divergence: float = DIVERGENCE
    least: int = LEAST
    pull: float = PULL
    shard: int = SHARD
    n: int = 0
    v: int = 0
    once: int = 0

    @property
    def dealt(self) -> int:
        """The count of contexts from which on they are dealt into shards."""
        return max(self.shard, self.n // 50_000)

    def held_out(self, ids: list) -> list:
        """Null for a row without a doc_id, which is not learned from either."""
        return [None if i is None else zlib.crc32(str(i).encode()) % self.mod == self.held for i in ids]

    def learned(self, ids: list) -> np.ndarray:
        return np.array([h is False for h in self.held_out(ids)], bool)


def joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value starts."""
    return np.append(True, sorted_values[1:] != sorted_values[:-1]) if len(sorted_values) else np.zeros(0, bool)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair, in the order of the pairs; where 64 bits are too few, by the places of ``a``'s values."""
    bits = int(b.max()).bit_length() if len(b) else 0
    if len(a) and int(a.max()).bit_length() + bits > 63:
        a = np.unique(a, return_inverse=True)[1]
    return (a.astype(np.uint64) << np.uint64(bits)) | b.astype(np.uint64)


def sorted_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs' order (stable) and their numbers in it; the place rides along in the same 64 bits where it fits, which sorts fastest."""
    key, bits = paired(a, b), np.uint64(max(1, len(a) - 1).bit_length())
    if len(key) and int(key.max()).bit_length() + int(bits) <= 64:
        whole = np.sort((key << bits) | np.arange(len(key), dtype=np.uint64))
        return (whole & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), whole >> bits
    order = np.argsort(key, kind="stable")
    return order, key[order]


def local(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (all under ``size``) and each one's place among them, without sorting."""
    there = np.zeros(size, bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def coded(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the place of each token's among them, and their counts; as np.unique, but sorts leading bits and place in one number."""
    bits = np.uint64(max(1, len(tokens) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((tokens & ~low) | np.arange(len(tokens), dtype=np.uint64)) & low).astype(np.int64)
    ordered = tokens[order]
    if (ordered[1:] < ordered[:-1]).any():  # different words agree in the leading bits
        return np.unique(tokens, return_inverse=True, return_counts=True)
    new = runs(ordered)
    place = np.empty(len(tokens), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    starts = np.flatnonzero(new)
    return ordered[starts], place, np.diff(np.append(starts, len(tokens)))


def _tokens(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Blocks of about ``most`` tokens: the doc_ids, numbers of tokens and hashes of whole texts."""
    held: list[tuple[list, np.ndarray, np.ndarray]] = []

    def block() -> tuple[list, np.ndarray, np.ndarray]:
        return [i for x, _, _ in held for i in x], np.concatenate([x for _, x, _ in held]), np.concatenate([x for _, _, x in held])

    for batch in batches:
        data, offsets = tb.buffers(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for i, j in tb.slices(offsets):
            _, _, h, first = tb.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            held.append((ids[i:j], np.diff(first) + 1, np.insert(h, first[1:], END)))
            if sum(len(x) for _, _, x in held) >= most:
                yield block()
                held = []
    if held:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks coded by their own words, the frequent ones with small codes: sorted by the bits of their count, then by hash."""
    place = TaskContext.get().partitionId()
    for seq, (ids, sizes, tokens) in enumerate(_tokens(batches, most)):
        words, token, counts = coded(tokens)
        classes = 64 - np.floor(np.log2(counts)).astype(np.int64)
        code = np.empty(len(words), np.int32)
        code[np.argsort(classes, kind="stable")] = np.arange(len(words))
        columns = [pa.array([(place << 32) + seq]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))]
        columns += [tb.binary_column([chunked.squeezed(x)]) for x in (chunked.pack(words), chunked.planes(classes), chunked.planes(code[token]))]
        yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "sizes", "words", "classes", "tokens"])


class Block:
    """A block's tokens."""

    def __init__(self, row: dict, corpus: Corpus):
        self.ids, self.sizes = row["ids"], np.array(row["sizes"], np.int64)
        self.words, classes, self.token = (f(chunked.opened_one(row[c])) for f, c in ((chunked.unpack, "words"), (chunked.unplanes, "classes"), (chunked.unplanes, "tokens")))
        self.token = self.token.astype(np.int32)
        self.sorted_code = np.argsort(classes.astype(np.uint8), kind="stable")  # the word of each code
        self.at = np.concatenate(([0], np.cumsum(self.sizes)))
        self.training = np.repeat(corpus.learned(self.ids), self.sizes)

    def send_words(self, block: int, buckets: int) -> pa.Table:
        n = np.empty(len(self.words), np.int64)
        n[self.sorted_code] = np.bincount(self.token[self.training], minlength=len(self.words))
        return chunked.sent([(b, block, WORDS, chunked.pack(self.words[s:e]), chunked.planes(n[s:e])) for b, s, e in chunked.cut(self.words, 64, buckets)])

    def hear_words(self, heard: pa.Table, corpus: Corpus) -> Level:
        """The root's predictions, and the first level: all tokens but the first of each text."""
        said = [[chunked.unplanes(p).astype(np.int64) for p in parted(a)] for _, a in chunked.gathered(heard, WORDS)]
        count, number = np.concatenate([x for x, _ in said]), np.zeros(len(self.words), np.int64)
        number[count >= corpus.least] = np.concatenate([x for _, x in said])
        self.word_count, number = count[self.sorted_code], number[self.sorted_code]
        unseen = max(1, corpus.once) / (corpus.n + 1) if corpus.n else 1.0
        self.p = np.where(self.word_count > 0, (1 - unseen) * self.word_count / max(1, corpus.n), unseen / (corpus.v + 1))[self.token]
        frequent = (self.word_count >= corpus.least)[self.token]
        inner = np.append(False, frequent[:-1])
        inner[self.at[:-1]] = False
        pos = np.flatnonzero(inner).astype(np.int32)
        return Level(pos, self.token[pos - 1], number, self.word_count, self.token[pos], number, frequent[pos], self.p[pos], self.training[pos])

    def documents(self, corpus: Corpus, level: Level) -> dict:
        """What is known of each text; score leaves out the tokens that are still in ``level``."""
        rest = np.log10(np.maximum(self.p, 1e-300))
        rest[level.pos] = 0
        add = lambda x: np.add.reduceat(x, self.at[:-1])
        base = np.log10((self.word_count + 1) / (corpus.n + 1 * (corpus.v + 1)))[self.token]
        return {"ids": self.ids, "n_tokens": self.sizes, "n_known": add((self.word_count > 0).astype(np.int64)[self.token]), "base": add(base), "score": add(rest)}


@dataclass
class Level:
    """The tokens (places in the block, ascending) that have a context on this level; contexts and words by their places in tables of the block."""

    pos: np.ndarray
    context: np.ndarray
    contexts: np.ndarray  # the contexts' numbers, ~(place * buckets + bucket) for those that stay in their bucket
    n: np.ndarray  # the contexts' counts
    word: np.ndarray
    words: np.ndarray  # the words' numbers
    able: np.ndarray  # whether context and word may be together ``least`` times
    p: np.ndarray  # of the token by the context's suffix
    training: np.ndarray

    def pack(self) -> bytes:
        contexts, context = local(self.context, len(self.contexts))
        words, word = local(self.word, len(self.words))
        steps = np.diff(self.pos, prepend=0)
        whole = (steps, context, self.contexts[contexts], self.n[contexts], word, self.words[words], self.able, self.training)
        return chunked.squeezed(joined(*[chunked.planes(x) for x in whole], self.p.tobytes()))

    @classmethod
    def unpack(cls, data: bytes) -> Level:
        *whole, p = parted(chunked.opened_one(data))
        steps, context, contexts, n, word, words, able, training = (chunked.unplanes(x).astype(np.int64) for x in whole)
        return cls(np.cumsum(steps), context, contexts, n, word, words, able > 0, np.frombuffer(p, np.float64), training > 0)

    @classmethod
    def nothing(cls) -> Level:
        return cls(*[np.zeros(0, np.int64)] * 9)


def finer(n: np.ndarray) -> np.ndarray:
    """Bits by which the steps of a context of count n are finer."""
    return np.maximum(np.frexp(n.astype(float))[1].astype(np.int64) - 4, 0)


class Asked:
    """The distinct contexts of a level and their next words, in the order in which they are sent."""

    def __init__(self, level: Level, corpus: Corpus):
        self.level, self.corpus = level, corpus
        there, self.context = local(level.context, len(level.contexts))
        number = level.contexts[there]
        by_number = np.lexsort((np.where(number < 0, ~number, number), number >= 0))
        back = np.empty(len(there), np.int32)
        back[by_number] = np.arange(len(back))
        there, self.context = there[by_number], back[self.context]
        self.numbers, self.n = level.contexts[there], level.n[there]
        able = np.flatnonzero(level.able)
        order, keys = sorted_pairs(self.context[able], level.word[able])
        order, new = able[order], runs(keys)
        self.pair = np.full(len(level.pos), -1, np.int32)
        self.pair[order] = np.cumsum(new, dtype=np.int32) - 1
        self.at = order[new]
        self.mine = self.context[self.at]
        self.word = level.words[level.word[self.at]]
        # A context that keeps nothing for sure is not sent: too few of its occurrences are left for a word that may diverge.
        lost = np.bincount(self.context[level.training & ~level.able], minlength=len(there))
        open_ = self.n - lost >= corpus.least
        open_[self.mine] = True
        shards = np.where(open_, 1 + self.n // corpus.dealt, 0)
        start = np.cumsum(shards) - shards
        self.owner = np.repeat(np.arange(len(shards)), shards)
        self.shard = np.arange(len(self.owner)) - start[self.owner]
        spread = tb.mix(self.numbers[self.owner].astype(np.uint64) * GOLDEN + self.shard.astype(np.uint64)) % np.uint64(corpus.buckets)
        number = self.numbers[self.owner]
        self.bucket = np.where(number < 0, ~number % corpus.buckets, spread.astype(np.int64))
        self.entry_order = np.argsort(self.bucket.astype(np.uint16) if corpus.buckets < 1 << 16 else self.bucket, kind="stable")
        rank = np.empty(len(self.entry_order), np.int64)
        rank[self.entry_order] = np.arange(len(rank))
        self.entry = rank[start[self.mine]]
        dealt = np.flatnonzero(shards[self.mine] > 1)
        mine = self.mine[dealt]
        self.entry[dealt] = rank[start[mine] + (tb.mix(self.word[dealt].astype(np.uint64)) % shards[mine].astype(np.uint64)).astype(np.int64)]
        self.pair_order = sorted_pairs(self.entry, self.word)[0]

    def send(self, block: int, kind: int) -> pa.Table:
        e, p, level = self.entry_order, self.pair_order, self.level
        counts = np.bincount(self.pair[level.able & level.training], minlength=len(p))
        fine = finer(self.n)
        scale = 1 << fine[self.mine]
        expected = np.rint(STEPS * scale * np.log2(np.maximum(self.n[self.mine] * level.p[self.at], 1e-300))).astype(np.int64) + ZERO * scale
        bucket, number, shard = self.bucket[e], self.numbers[self.owner[e]], self.shard[e]
        many = np.bincount(self.entry, minlength=len(e))
        word, counts, expected = self.word[p], counts[p], expected[p]
        steps = np.diff(word, prepend=0)
        upto = np.concatenate(([0], np.cumsum(many)))
        first = upto[:-1][many > 0]
        steps[first] = word[first]
        # Words are numbered by frequency, so expectations of neighbours are close.
        drops = np.diff(expected, prepend=0)
        drops = (drops << 1) ^ (drops >> 63)
        drops[first] = expected[first]
        is_first = np.zeros(len(p), bool)
        is_first[first] = True
        starts = np.flatnonzero(runs(bucket))
        rows = []
        for s, t in zip(starts, np.append(starts[1:], len(e))):
            a, b = upto[s], upto[t]
            own = number[s:t]
            stay = own < 0  # these come first
            places, others = ~own[stay] // self.corpus.buckets, own[~stay]
            contexts = joined(*[chunked.pack(x.astype(np.uint64)) for x in (places, others)], *[chunked.planes(x) for x in (shard[s:t], many[s:t], fine[self.owner[e[s:t]]])])
            d, f = drops[a:b], is_first[a:b]
            rows.append((int(bucket[s]), block, kind, contexts, joined(*[chunked.planes(x) for x in (steps[a:b], counts[a:b], d[f], d[~f])])))
        return chunked.sent(rows)

    def hear(self, answers: list[tuple[int, bytes]], stay: int = 0) -> Level:
        """Update the level's predictions and give the next one: tokens whose context is a state, and the context that reaches one word further back.

        Pairs that occur less than ``stay`` times stay in their bucket and have no number.
        """
        level, least, pull = self.level, self.corpus.least, self.corpus.pull
        if not answers:
            return Level.nothing()
        told = [(bucket, *parted(a)) for bucket, a in answers]
        kept_sum, said = (np.concatenate([chunked.unplanes(t[i]).astype(np.int64) for t in told]) for i in (1, 2))
        number = np.concatenate([numbers_of(chunked.unplanes(t[2]).astype(np.int64), chunked.unpack(t[3]).astype(np.int64), t[0], self.corpus, stay) for t in told])
        r = np.bincount(self.owner[self.entry_order], kept_sum, len(self.numbers))
        says, numbers = np.zeros(len(said) + 1, np.int64), np.zeros(len(said) + 1, np.int64)  # the last place is that of tokens that asked for no pair
        says[self.pair_order] = said
        numbers[self.pair_order[said > 0]] = number
        totals, share = says >> 1, np.zeros(len(says))
        share[:-1] = np.where(says[:-1] & 1, totals[:-1] / (self.n[self.mine] + pull), 0.0)
        level.p = share[self.pair] + (1 - r / (self.n + pull))[self.context] * level.p
        # The first token of a text is on no level, so a neighbour stands in the same text.
        again, state = (totals >= least)[self.pair], (r > 0)[self.context]
        go = np.flatnonzero((level.pos[1:] == level.pos[:-1] + 1) & again[:-1] & state[1:]) + 1
        before = self.pair[go - 1]
        return Level(level.pos[go], before, numbers, totals, level.word[go], level.words, again[go], level.p[go], level.training[go])


def numbers_of(said: np.ndarray, names: np.ndarray, bucket: int, corpus: Corpus, stay: int) -> np.ndarray:
    """Numbers of the pairs that lead on, of those that a block sent to a bucket."""
    totals = said[said > 0] >> 1
    out = ~(np.arange(len(totals)) * corpus.buckets + bucket)
    out[totals >= stay] = names * corpus.buckets + bucket
    return out


def _columns(table: pa.Table):
    """What the blocks sent, in order of block: a bucket may be worked out more than once, and must come out alike."""
    table = table.sort_by([("chunk", "ascending")])
    return table.column("bucket")[0].as_py(), table.column("chunk").to_pylist(), chunked.opened(table.column("keys")), chunked.opened(table.column("extra"))


def numbered(total: np.ndarray, bucket: int, corpus: Corpus) -> np.ndarray:
    """Numbers that no other bucket gives, small ones for frequent things; 0 for what is too rare to need one."""
    out = np.zeros(len(total), np.int64)
    alive = np.flatnonzero(total >= corpus.least)
    out[alive[np.argsort(-total[alive], kind="stable")]] = np.arange(len(alive)) * corpus.buckets + bucket
    return out


def _count_words(corpus: Corpus):
    """Training counts of a range of words, and numbers of those that need one, for each block that has them."""

    def run(table: pa.Table) -> pa.Table:
        bucket, blocks, keys, extra = _columns(table)
        keys = [chunked.unpack(k) for k in keys]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate([chunked.unplanes(x) for x in extra]).astype(float), len(every)).astype(np.int64)
        number, total = numbered(total, bucket, corpus)[place], total[place]
        rows, at = [], np.cumsum([0] + [len(k) for k in keys])
        for c, a, b in zip(blocks, at, at[1:]):
            n = total[a:b]
            rows.append((c, bucket, WORDS, joined(chunked.planes(n), chunked.planes(number[a:b][n >= corpus.least]))))
        return chunked.answers(rows)

    return run


def _sum_words(table: pa.Table) -> pa.Table:
    """Of a range of words: training tokens, words, and words that occur once."""
    _, _, keys, extra = _columns(table)
    every, place = np.unique(np.concatenate([chunked.unpack(k) for k in keys]), return_inverse=True)
    total = np.bincount(place, np.concatenate([chunked.unplanes(x) for x in extra]).astype(float), len(every)).astype(np.int64)
    return pa.table({"n": [int(total.sum())], "v": [int((total > 0).sum())], "once": [int((total == 1).sum())]})


@dataclass
class Counted:
    """What the blocks sent to a bucket on one level, and the counts of its pairs over all blocks."""

    blocks: list[int]
    lengths: list[tuple[int, int]]  # each block's contexts and pairs
    entry: np.ndarray  # the place of each context (of a block, with its shard) among the distinct ones
    owner: np.ndarray  # the context of each pair
    place: np.ndarray  # of each pair among the distinct ones
    order: np.ndarray  # in which equal pairs stand together
    new: np.ndarray  # where in that order another pair starts
    total: np.ndarray  # of each distinct pair
    name: np.ndarray  # of each distinct pair among those that lead on
    fine: np.ndarray  # of each context
    firsts: np.ndarray  # the first pair of each context that has any
    runs: np.ndarray  # and how many it has
    pairs: list[list[bytes]]

    def alive(self, least: int) -> dict[int, np.ndarray]:
        """For each block the names of its pairs that lead on, in the order in which it sent them."""
        out, p = {}, 0
        for c, (_, m) in zip(self.blocks, self.lengths):
            mine = self.place[p : p + m]
            out[c] = self.name[mine[self.total[mine] >= least]]
            p += m
        return out


def summed(steps: np.ndarray, firsts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Running sums of the differences, anew from each of ``firsts``."""
    upto = np.cumsum(steps)
    return upto - np.repeat(upto[firsts] - steps[firsts], runs)


def counted(table: pa.Table, corpus: Corpus, names: dict[int, np.ndarray]) -> Counted:
    """Counts of the contexts' next words. ``names`` has the names of the pairs that stayed in this bucket, by block."""
    _, blocks, keys, extra = _columns(table)
    contexts, pairs = [parted(k) for k in keys], [parted(x) for x in extra]
    stayed = [names[b][chunked.unpack(c[0]).astype(np.int64)] if c[0] else np.zeros(0, np.int64) for b, c in zip(blocks, contexts)]
    most = max((int(x[-1]) + 1 for x in stayed if len(x)), default=0)
    numbers = [np.concatenate((x, chunked.unpack(c[1]).astype(np.int64) + most)) for x, c in zip(stayed, contexts)]
    words = [chunked.unplanes(x[0]) for x in pairs]
    shard, many, fine = (np.concatenate([chunked.unplanes(c[i]) for c in contexts]) for i in (2, 3, 4))
    counts, many = np.concatenate([chunked.unplanes(x[1]) for x in pairs]), many.astype(np.int64)
    firsts, lengths = (np.cumsum(many) - many)[many > 0], many[many > 0]
    number, word = np.concatenate(numbers), summed(np.concatenate(words), firsts, lengths)
    owner = np.repeat(np.arange(len(number)), many)
    entries, entry = np.unique(paired(number, shard), return_inverse=True)
    order, sorted_keys = sorted_pairs(entry[owner], word)
    new = runs(sorted_keys)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    total = np.bincount(place, counts.astype(float), int(new.sum())).astype(np.int64)
    # A bucket numbers the pairs in the order in which every block sent them.
    name = np.cumsum(total >= corpus.least) - 1
    return Counted(blocks, [(len(x), len(w)) for x, w in zip(numbers, words)], entry, owner, place, order, new, total, name, fine, firsts, lengths, pairs)


def _grow(corpus: Corpus, upto: int | None = None, stay: int = 0):
    """Counts of the contexts' next words, the divergence test, the sum that each context keeps, and numbers for the longer contexts.

    With ``upto`` the rows are those of all levels up to that one, and its answers are given. Pairs that occur less than ``stay`` times get no number.
    """

    def unfolded(pairs: list[list[bytes]], firsts: np.ndarray, n: int) -> np.ndarray:
        """Differences of the expectations, the first of each context whole."""
        out, is_first = np.zeros(n, np.int64), np.zeros(n, bool)
        is_first[firsts] = True
        out[is_first] = np.concatenate([chunked.unplanes(x[2]) for x in pairs])
        drops = np.concatenate([chunked.unplanes(x[3]) for x in pairs]).astype(np.int64)
        out[~is_first] = (drops >> 1) ^ -(drops & 1)
        return out

    def run(table: pa.Table) -> pa.Table:
        bucket, names = table.column("bucket")[0].as_py(), {}
        kind = upto or table.column("kind")[0].as_py()
        for k in range(1 if upto else kind, kind):
            rows = table.filter(pa.compute.equal(table.column("kind"), k))
            names = counted(rows, corpus, names).alive(corpus.least) if rows.num_rows else {}
        table = table.filter(pa.compute.equal(table.column("kind"), kind))
        if not table.num_rows:
            return chunked.answers([])
        of = counted(table, corpus, names)
        total, place, entry = of.total, of.place, of.entry
        expected = summed(unfolded(of.pairs, of.firsts, len(place)), of.firsts, of.runs)
        first = of.order[of.new]
        level = np.maximum.reduceat(expected[of.order], np.flatnonzero(of.new)) if len(first) else total
        scale = 1 << of.fine.astype(np.int64)[of.owner[first]]
        kept = (total >= corpus.least) & (total * (np.log(np.maximum(total, 1)) - (level / scale - ZERO) / STEPS * np.log(2)) >= corpus.divergence)
        sums = np.bincount(entry[of.owner[first]], np.where(kept, total, 0), int(entry.max(initial=-1)) + 1).astype(np.int64)[entry]
        say, name = np.where(total >= corpus.least, 2 * total + kept, 0)[place], of.name[place]
        told = (say > 0) & (say >> 1 >= stay)
        rows, e, p = [], 0, 0
        for c, (n, m) in zip(of.blocks, of.lengths):
            n, m = e + n, p + m
            rows.append((c, bucket, kind, joined(chunked.planes(sums[e:n]), chunked.planes(say[p:m]), chunked.pack(name[p:m][told[p:m]].astype(np.uint64)))))
            e, p = n, m
        return chunked.answers(rows)

    return run


def _state(block: int, documents: dict, level: Level) -> pa.Table:
    of = lambda x, kind: pa.array([list(x)], pa.list_(kind))
    columns = [pa.array([block], pa.int64())] + [of(documents[c], pa.int64()) for c in ("ids", "n_tokens", "n_known")] + [of(documents[c], pa.float64()) for c in ("base", "score")]
    return pa.table(columns + [pa.array([len(level.pos)], pa.int64()), tb.binary_column([level.pack()])], names=["block", *DOCS, "active", "arrays"])


def _finished(row: dict, level: Level, done: np.ndarray) -> np.ndarray:
    """The texts' scores with the tokens of ``level`` that are ``done``."""
    ends = np.cumsum(row["n_tokens"])
    owner = np.searchsorted(ends, level.pos[done], side="right")
    return np.array(row["score"]) + np.bincount(owner, np.log10(np.maximum(level.p[done], 1e-300)), len(ends))


def _closed(batch: pa.RecordBatch) -> pa.Table:
    """The tree's blocks with the tokens that are left on the last level."""
    rows = batch.to_pylist()
    for row in rows:
        level = Level.unpack(row.pop("arrays"))
        row["score"] = _finished(row, level, np.ones(len(level.pos), bool))
    kinds = dict(zip(DOCS, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())))
    return pa.table({c: pa.array([list(r[c]) for r in rows], pa.list_(k)) for c, k in kinds.items()})


def score(docs: DataFrame, mod: int = 7, held: int = 2, divergence: float = DIVERGENCE, least: int = LEAST, pull: float = PULL, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text) whose crc32(doc_id) mod ``mod`` is not ``held``, and score every row.

    base_score is the add-one unigram score; score the tree's log10 probability. Null
    and empty texts are the end token only. Repeated rows count each time; a row without a
    doc_id is scored, has a null held_out and is not learned from; other columns are ignored; an
    empty table gives an empty result, and without training rows every token is unseen.
    """
    buckets, tasks = chunked.bucket_count(docs, 16 << 20, 32), chunked.bucket_count(docs, 6 << 20, 16)
    plain = Corpus(mod, held, buckets, divergence, least, pull, shard)
    # In a fixed order, blocks come out alike however often a task runs.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").sortWithinPartitions("doc_id", "text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (ids, sizes, tokens) in enumerate(_tokens(batches, max(block, 1 << 22))):
            words, n = np.unique(tokens[np.repeat(plain.learned(ids), sizes)], return_counts=True)
            yield from chunked.sent([(b, k, WORDS, chunked.pack(words[s:e]), chunked.planes(n[s:e])) for b, s, e in chunked.cut(words, 64, buckets)]).to_batches()

    sums = texts.mapInArrow(count_words, chunked.SENT).groupBy("bucket").applyInArrow(_sum_words, "n bigint, v bigint, once bigint")
    found = sums.agg(*[F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).alias(c) for c in ("n", "v", "once")]).first()
    corpus = replace(plain, **{c: int(found[c]) for c in ("n", "v", "once")})
    by_block = texts.mapInArrow(lambda batches: _blocks(batches, block), TOKENS).repartition(tasks, "block").groupBy("block")

    def words(key, table):
        return Block(table.to_pylist()[0], corpus).send_words(key[0].as_py(), buckets)

    def replayed(table: pa.Table, heard: pa.Table, upto: int) -> tuple[Block, Level]:
        tokens = Block(table.to_pylist()[0], corpus)
        level = tokens.hear_words(heard, corpus)
        for k in range(1, upto):
            deeper = Asked(level, corpus).hear(chunked.gathered(heard, k), stay(k))
            tokens.p[level.pos] = level.p
            level = deeper
        return tokens, level

    def asking(upto: int):
        def run(key, table, heard):
            if not table.num_rows:
                return chunked.sent([])
            return Asked(replayed(table, heard, upto)[1], corpus).send(key[0].as_py(), upto)

        return run

    def told(sent: DataFrame, answer) -> DataFrame:
        """Answers dealt by block: the cogroups that read them find them there, and none is sent twice."""
        return sent.groupBy("bucket").applyInArrow(answer, chunked.ANSWER).repartition(tasks, "chunk")

    def stay(level: int) -> int:
        """The jobs that follow see nothing of this one's levels, so all pairs of the last one get numbers."""
        return corpus.dealt if level < UNROLLED else 0

    heard, sent = told(by_block.applyInArrow(words, chunked.SENT), _count_words(corpus)), None
    for k in range(1, UNROLLED + 1):
        asked = by_block.cogroup(heard.groupBy("chunk")).applyInArrow(asking(k), chunked.SENT).repartition(tasks, "bucket")
        sent = sent.unionAll(asked) if sent else asked
        heard = heard.unionAll(told(sent, _grow(corpus, k, stay(k))))

    def begun(key, table, heard):
        if not table.num_rows:
            return _state(0, {c: [] for c in DOCS}, Level.nothing()).slice(0, 0)
        tokens, level = replayed(table, heard, UNROLLED + 1)
        return _state(key[0].as_py(), tokens.documents(corpus, level), level)

    state = staged(by_block.cogroup(heard.groupBy("chunk")).applyInArrow(begun, STATE), "tree")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from Asked(Level.unpack(row["arrays"]), corpus).send(row["block"], 1).to_batches()

    def deepened(key, table, heard):
        row = table.to_pylist()[0]
        level = Level.unpack(row["arrays"])
        deeper = Asked(level, corpus).hear(chunked.gathered(heard, 1)) if row["active"] else level
        row["score"] = _finished(row, level, ~np.isin(level.pos, deeper.pos))
        return _state(row["block"], row, deeper)

    while state.agg(F.coalesce(F.sum("active"), F.lit(0))).first()[0]:
        sent = state.where("active > 0").mapInArrow(ask, chunked.SENT).groupBy("bucket").applyInArrow(_grow(corpus), chunked.ANSWER)
        state = staged(state.groupBy("block").cogroup(sent.groupBy("chunk")).applyInArrow(deepened, STATE), "tree")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _closed(batch)
            flat = {c: batch.column(c).combine_chunks().flatten() for c in DOCS}
            held_out = pa.array(corpus.held_out(flat["ids"].to_pylist()), pa.bool_())
            train = pa.array(np.full(len(held_out), corpus.n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [flat["ids"], held_out, flat["n_tokens"], flat["n_known"], train, flat["base"], flat["score"]],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return state.mapInArrow(rows, RESULT)

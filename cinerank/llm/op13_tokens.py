"""Token-ID output: documents as ids of a public tokenizer, in shards compressed by Re-Pair grammars.

Documents are put in ascending ``doc_id`` order by a range exchange; every task
reads its range as a stream, encodes whole texts, appends ``end_id`` to each and
closes a shard after the slice of rows with which it reaches ``shard_tokens`` ids.  A shard holds whole
documents and is compressed on its own by Re-Pair: the most frequent pairs of
neighbouring ids become nonterminals (ids from ``base`` on), the shortened
sequence is counted again, and so on with falling thresholds until no pair occurs
``MIN_USES`` times.  Pairs never reach over the end of a document, so every
document is a whole run of symbols.

File format (Parquet, zstd, one row a shard; numbers little-endian unsigned 32 bit):

=================  ==========================================================
``part, seq``      place of the shard: range of the exchange, number within it
``n_docs, n_tokens``  documents and ids of the shard
``base``           first nonterminal
``rules``          (left, right) of nonterminal ``base``, ``base + 1``, ...
``rule_lengths``   how many ids each nonterminal expands to
``symbols``        the compressed sequence
``doc_ids, doc_tokens``  the documents in order, and their ids with the end id
=================  ==========================================================

``shards`` adds ``start``, the ids of all shards before; ``read_documents`` returns
every document; ``read_tokens`` decodes any run of ids and, through the expansion
lengths, expands only the symbols that the run touches.

``by_word`` encodes each distinct run of non-blanks of a slice once.  That equals
the encoding of the whole text for a tokenizer that drops white space and
pre-splits at it, as the default one does (a test compares the two); set it to
False for any other tokenizer.

Defined results: a null or empty text is the end id alone; null ids come first;
rows with equal ids are ordered by a hash of their texts, equal rows are
interchangeable and all kept; other columns are ignored whatever their names; an
empty table gives a file without shards; a document longer than a shard makes a
longer shard.
"""

from __future__ import annotations

import itertools
import json
import math
import os
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinerank.llm.common import maybe_broadcast, text_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A pair becomes a rule only if it is replaced this often (a rule itself takes three numbers).
MIN_USES = 8
#: Each count takes pairs down to the largest number (or the last threshold) divided by this.
FALL = 3
#: Pairs are counted in this many buckets (as a power of two) before the frequent ones are sorted.
BUCKET_BITS = 19
#: Distinct words and marks that a task remembers with their ids; forgetting them only costs time.
REMEMBERED = 1 << 20
#: Distinct words that the tokenizer gets at once.
WORDS = 1_024
#: Text bytes encoded at once (a single longer text still goes whole): words repeat more in longer runs.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 16_384
#: Ranges of the exchange at most; a range is read as a stream, so its size bounds nothing.
MAX_PARTS = 20_000
FORMAT = (
    "part int, seq int, n_docs long, n_tokens long, base long, rules binary, rule_lengths binary, "
    "symbols binary, doc_ids array<long>, doc_tokens array<long>"
)


# --- grammar ------------------------------------------------------------------


def repair(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules) of ``ids``; ``last`` marks ids that end a document, ``rules`` has a row (left, right) each."""
    seq, ends = ids.astype(np.uint32), np.flatnonzero(last)
    rules: list[np.ndarray] = []
    made, least, mark, at = 0, None, 1 << BUCKET_BITS, None
    while len(seq) > 1:
        if at is None:
            # a bucket's count bounds the count of each of its pairs from above
            bucket = _bucket(seq[:-1], seq[1:])
            bucket[ends[ends < len(bucket)]] = mark
            full = np.bincount(bucket, minlength=mark + 1)
            full[mark] = 0
            least = max(MIN_USES, min(int(full.max()), least or 1 << 40) // FALL)
            at = np.flatnonzero((full >= least)[bucket])
            bucket = bucket[at]
        else:
            bucket = _bucket(seq[at], seq[at + 1])
        key = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        pairs, n = np.unique(key, return_counts=True)
        pairs, n = pairs[n >= least], n[n >= least]
        at, go, p = _choose(at, key, bucket, pairs, n)
        again = None
        if len(go):
            # numbers of the pairs that are replaced, in the order of the pairs
            taken = np.bincount(p, minlength=len(pairs)) > 0
            used, number = np.flatnonzero(taken), np.cumsum(taken) - 1
            seq[go] = (base + made + number[p]).astype(np.uint32)
            names = pairs[used]
            rules.append(np.stack([names >> np.uint64(32), names & np.uint64(0xFFFFFFFF)], axis=1))
            made += len(names)
            # where a right half ended a document, its nonterminal does
            ends = ends - np.searchsorted(go + 1, ends, side="right")
            keep = np.ones(len(seq), dtype=bool)
            keep[go + 1] = False
            seq = seq[keep]
            if least == MIN_USES:
                # at the same threshold only pairs that were frequent just now, or hold a new nonterminal, can be frequent
                new = go - np.arange(len(go))
                left = np.zeros(len(keep), dtype=bool)
                left[at] = True
                left = left[keep]
                left[new], left[new[new > 0] - 1] = True, True
                left[ends], left[-1] = False, False
                again = np.flatnonzero(left)
        at = again
        if least == MIN_USES and len(go) <= len(seq) // 256:
            break
    out = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.uint64)
    return seq.astype("<u4"), out.astype("<u4")


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * np.uint32(0x9E3779B1)
    out ^= right * np.uint32(0x85EBCA77)
    out >>= np.uint32(32 - BUCKET_BITS)
    return out.astype(np.intp)


def _choose(at: np.ndarray, key: np.ndarray, bucket: np.ndarray, pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all the pairs, those to replace and the number of the pair at each of these; where two overlap the more frequent pair goes first, then the left one."""
    if len(pairs) == 0:
        return at[:0], at[:0], at[:0]
    # nearly every bucket holds one of the pairs at most; the others are looked for among them all
    of = _bucket((pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32))
    table = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
    table[of] = np.arange(len(pairs))
    shared = np.zeros(1 << BUCKET_BITS, dtype=bool)
    shared[of[table[of] != np.arange(len(pairs))]] = True
    where = table[bucket]
    again = np.flatnonzero(shared[bucket])
    where[again] = np.minimum(np.searchsorted(pairs, key[again]), len(pairs) - 1)
    hit = pairs[where] == key
    at, where = at[hit], where[hit]
    rank = np.empty(len(pairs), dtype=np.int64)
    rank[np.lexsort((pairs, -n))] = np.arange(len(pairs))
    p = rank[where]
    good = np.ones(len(at), dtype=bool)
    touch = np.flatnonzero(at[1:] == at[:-1] + 1)
    good[touch + 1] &= p[touch + 1] < p[touch]
    good[touch] &= p[touch] <= p[touch + 1]
    go, where = at[good], where[good]
    enough = np.bincount(where, minlength=len(pairs)) >= MIN_USES
    return at, go[enough[where]], where[enough[where]]


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each nonterminal expands to; a rule only names earlier symbols."""
    out = np.zeros(len(rules), dtype=np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = (1 if a < base else out[a - base]) + (1 if b < base else out[b - base])
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids behind ``symbols``."""
    s = symbols.astype(np.int64)
    while len(big := np.flatnonzero(s >= base)):
        width = np.ones(len(s), dtype=np.int64)
        width[big] = 2
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.int64)
        out[at] = s
        pair = rules[s[big] - base]
        out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
        s = out
    return s.astype("<u4")


def gather(rows: pa.Array, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the runs of ids of all ``rows``, one after another; run r is the r-th of the lengths ``size`` in ``flat``."""
    offs = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]) * 4
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(flat, dtype="<u4"))])
    _, ends, data = runs.take(rows).buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[: len(rows) + 1] // 4 if len(rows) else np.zeros(1, dtype=np.int64)
    return np.frombuffer(data, dtype="<u4", count=ends[-1]) if ends[-1] else np.zeros(0, dtype="<u4"), ends


class Shard:
    """A row of the file."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2)
        self.rule_lengths = np.frombuffer(row["rule_lengths"], dtype="<u4").astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], dtype="<u4").astype(np.int64)

    def ids(self) -> np.ndarray:
        """All ids: every nonterminal is expanded once, then copied."""
        if len(self.rules) == 0:
            return self.symbols.astype("<u4")
        flat = np.concatenate([np.arange(self.base, dtype="<u4"), expand(np.arange(self.base, self.base + len(self.rules)), self.rules, self.base)])
        size = np.concatenate([np.ones(self.base, dtype=np.int64), self.rule_lengths])
        return gather(pa.array(self.symbols), flat, size)[0]

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``, from the symbols that hold them."""
        wide = self.symbols >= self.base
        size = np.ones(len(self.symbols), dtype=np.int64)
        size[wide] = self.rule_lengths[self.symbols[wide] - self.base]
        ends = np.cumsum(size)
        i, j = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        skip = start - int(ends[i] - size[i]) if i < len(ends) else 0
        return expand(self.symbols[i:j], self.rules, self.base)[skip : skip + stop - start]


# --- texts to ids -------------------------------------------------------------


#: A word of Latin-1 letters and closing marks: the marks are a piece of their own for the pre-splitter,
#: and the letters are the same to the normaliser in lower case.
STEM = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?]*)$"
#: A normaliser and pre-splitter that leave a lower-case stem as it is, and take any run of ASCII marks behind it whole.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
STEM_ANY_MARKS = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"


class _Known:
    """Pieces that a task has met, by number, and their ids in one flat array."""

    def __init__(self):
        #: a piece that is asked for gets the next number if it has none
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.number[""]  # number 0, without ids
        self.size, self.flat = [np.zeros(1, dtype=np.int64)], []

    def numbers(self, pieces: pa.Array) -> tuple[np.ndarray, list[str]]:
        """(number of each piece, pieces not met before); the ids of the latter are to be added next."""
        met, d = len(self.number), pieces.dictionary_encode()
        names = d.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.number.__getitem__, names), dtype=np.int64, count=len(names))
        return number[d.indices.to_numpy(zero_copy_only=False)], names[number >= met].tolist()

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.size.append(size)
        self.flat.append(ids)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, size) by number."""
        self.size, self.flat = [np.concatenate(self.size)], [np.concatenate(self.flat or [np.zeros(0, dtype=np.uint32)])]
        return self.flat[0], self.size[0]


class Encoder:
    """Ids of a run of texts, without the end ids, and the number of each text's ids."""

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.by_word, self.known = Tokenizer.from_file(path), by_word, _Known()
        self.base = self.tok.get_vocab_size(with_added_tokens=True)
        suffix = getattr(self.tok.model, "end_of_word_suffix", None) or ""
        self.closing = np.zeros(self.base, dtype=bool)
        if by_word and suffix:
            self.closing[[i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.plain, self.stem = self.tok, STEM
        if by_word and self._takes_stems_whole():
            # the same model; only what changes nothing of a stem is left out
            self.plain, self.stem = Tokenizer(self.tok.model), STEM_ANY_MARKS
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _takes_stems_whole(self) -> bool:
        parts = self.tok.normalizer, self.tok.pre_tokenizer
        return all(parts) and [json.loads(p.__getstate__()) for p in parts] == [NORMALIZER, SPLITTER]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each text's ids)."""
        return self._in_runs(texts, self._each_of)

    def _stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for letter-only words, from one encoding of a run of them; only a word's last id closes a word."""
        return self._in_runs(stems, self._stems_of)

    def _in_runs(self, texts: list[str], of) -> tuple[np.ndarray, np.ndarray]:
        """The tokenizer keeps far more of a text than its ids, so it gets a bounded number of words at once."""
        made = [of(texts[i : i + WORDS]) for i in range(0, len(texts), WORDS)] or [(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))]
        return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])

    def _each_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(g) for g in got], dtype=np.int64)
        return np.fromiter(itertools.chain.from_iterable(got), dtype=np.uint32, count=int(size.sum())), size

    def _stems_of(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.plain.encode_batch_fast([" ".join(stems)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(stems) or (len(ids) and ends[-1] != len(ids)):
            return self._each_of(stems)
        return ids, np.diff(ends, prepend=0)

    def _numbers(self, pieces: pa.Array, of) -> np.ndarray:
        """Number of each piece; pieces that this task has met are not encoded again."""
        number, fresh = self.known.numbers(pieces)
        if fresh:
            self.known.add(*of(fresh))
        return number

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            return self._each(texts.to_pylist())
        if len(self.known.number) > REMEMBERED:
            self.known = _Known()
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        names = words.dictionary
        found = pc.extract_regex(names, self.stem)
        whole = pc.is_null(found)
        # a word is its stem (the empty piece for none) and its tail or its whole
        pair = np.zeros((len(names), 2), dtype=np.int64)
        pair[~whole.to_numpy(zero_copy_only=False), 0] = self._numbers(pc.utf8_lower(found.field("stem").filter(pc.invert(whole))), self._stems)
        pair[:, 1] = self._numbers(pc.if_else(whole, names, found.field("tail")), self._each)
        flat, size = self.known.arrays()
        # the ids of each distinct word, then those of each word
        own, _ = gather(pa.array(pair.ravel()), flat, size)
        ids, ends = gather(words.indices, own, size[pair[:, 0]] + size[pair[:, 1]])
        offs = lists.offsets.to_numpy()
        return ids, np.diff(ends[offs - offs[0]])


def _shard_row(part: int, seq: int, doc_ids: list, ids: np.ndarray, n: np.ndarray, base: int) -> pa.RecordBatch:
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(n) - 1] = True
    symbols, rules = repair(ids, last, base)
    row = {
        "part": part, "seq": seq, "n_docs": len(n), "n_tokens": len(ids), "base": base, "rules": rules.tobytes(),
        "rule_lengths": rule_lengths(rules, base).astype("<u4").tobytes(), "symbols": symbols.tobytes(),
        "doc_ids": doc_ids, "doc_tokens": n.tolist(),
    }
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row.values(), kinds)], names=list(row))


def encode(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", by_word: bool = True, shard_tokens: int = 1 << 20, part_bytes: int = 64 << 20) -> None:
    """Write the ids of all ``docs`` to ``path`` in the format above."""
    if shard_tokens < 1 or part_bytes < 1 or end_id < 0:
        raise ValueError("shard_tokens and part_bytes must be at least 1 and end_id not negative")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = d.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = min(MAX_PARTS, max(1, math.ceil(size / part_bytes)))
    # the last two keys spread rows that share an id, or are wholly alike, over several ranges
    d = d.withColumn("h", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), F.asc("h"), F.asc("at")]
    d = d.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = Encoder(tokenizer, by_word), TaskContext.get().partitionId(), 0
        base = max(enc.base, end_id + 1)
        held, names, tokens = [], [], 0
        for rb, _, _ in text_slices(batches, most=SLICE_BYTES, rows=SLICE_ROWS):
            ids, n = enc(pc.fill_null(rb.column(1), ""))
            held.append((np.insert(ids, np.cumsum(n), end_id), n + 1))
            names += rb.column(0).to_pylist()
            tokens += len(ids) + len(n)
            if tokens >= shard_tokens:
                yield _shard_row(part, seq, names, *(np.concatenate(x) for x in zip(*held)), base)
                seq, held, names, tokens = seq + 1, [], [], 0
        if names:
            yield _shard_row(part, seq, names, *(np.concatenate(x) for x in zip(*held)), base)

    d.mapInArrow(shards_of, FORMAT).write.option("compression", "zstd").parquet(path)


# --- reading ------------------------------------------------------------------


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids before each."""
    s = spark.read.schema(FORMAT).parquet(path)
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_part = s.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))  # MAX_PARTS rows at most
    by_part = by_part.select("part", before(Window.orderBy("part")).alias("part_start"))
    at = s.select("part", "seq", "n_tokens").withColumn("in_part", before(Window.partitionBy("part").orderBy("seq")))
    at = at.join(F.broadcast(by_part), "part").select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("start"))
    return s.join(maybe_broadcast(at, 32), ["part", "seq"])


def _rows(rb: pa.RecordBatch) -> Iterator[dict]:
    for i in range(rb.num_rows):
        yield {n: rb.column(j)[i].as_py() for j, n in enumerate(rb.schema.names)}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit integers) of every document."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for row in _rows(rb):
                n = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(n)
                ids = Shard(row).ids()
                offs = np.concatenate([[0], ends]) * 4
                for i in range(0, len(n), 4096):
                    k = slice(i, min(i + 4096, len(n)))
                    bufs = [None, pa.py_buffer((offs[k.start : k.stop + 1] - offs[k.start]).astype(np.int64)), pa.py_buffer(ids[offs[k.start] // 4 : offs[k.stop] // 4])]
                    blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), k.stop - k.start, bufs).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"][k], pa.int64()), pa.array(row["start"] + ends[k] - n[k]), pa.array(n[k]), blob], names=["doc_id", "start", "n_tokens", "ids"])

    return shards(spark, path).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """``start, ids`` pieces of the run of ``count`` ids from ``start`` on, one per shard that holds some of it."""
    s = shards(spark, path).where((F.col("start") < start + count) & (F.col("start") + F.col("n_tokens") > start))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for row in _rows(rb):
                a, b = max(0, start - row["start"]), min(row["n_tokens"], start + count - row["start"])
                yield pa.RecordBatch.from_arrays([pa.array([row["start"] + a]), pa.array([Shard(row).run(a, b).tobytes()], pa.binary())], names=["start", "ids"])

    return s.mapInArrow(cut, "start long, ids binary")

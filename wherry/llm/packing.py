"""Bounded-space online best-fit packing of tokenized documents into fixed-length sequences.

Tokens: a document is split at ASCII white space, which the tokenizer drops and no token of it spans, so the parts
between are encoded once each and kept in a bounded cache. A text with a special string inside goes to the library whole.
A very long text is a slice of its own and is encoded like any other.

Packing: only (doc_id, piece, length, checksum) rows are shuffled, by hash, so no source or group is hot. Each task keeps
at most `max_open` open bins in a bitset keyed by free space: the lowest set bit at or above a length is the best
fit, the lowest set bit of all is the fullest bin, which closes first when every place is taken.

Defined cases: a null text is the empty text, which is the end token alone; every row is a document of its own, also
if doc_id repeats or is null; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, groups_for, slices

CAPACITY = 4096
END_ID = 1
MAX_OPEN = 2048
DOCS_PER_TASK = 20_000
CACHE_WORDS = 1_000_000
ENCODE_AT_ONCE = 4096
WORD_END = "</w>"
#: Letters, each a single code point that normalizes to itself and has one lower case, and then ASCII marks that are never part of a contraction.
PLAIN_PART = "^(?P<letters>[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)(?P<marks>[.,;:!?#*$%&|]*)$"


class WordEncoder:
    """Token ids of whole texts, for a tokenizer that drops white space.

    The parts between white space of a slice of texts are told apart once, and each different one has a run in one array of ids, from
    which the texts are gathered. A part that is letters and then marks is two pre-tokens, and its letters, lower-cased, need neither
    normalizing nor splitting: they go to the merges directly, once for all ways of writing them. Every other part goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges, self.ends_word = None, np.zeros(0, bool)
        if self._is_plain():
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends_word = np.zeros(1 + max(vocabulary.values()), bool)
            self.ends_word[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._clear()

    def _clear(self) -> None:
        self.known = {kind: (pa.array([], pa.string()), np.zeros(0, np.int64)) for kind in ("letters", "other")}
        self.ids = np.zeros(1 << 16, "<u4")
        self.stops = np.zeros(1 << 16, np.int64)  # run r of ids ends at stops[r]; run 0 is empty
        self.runs = 1
        self.end = int(self._append(np.array([END_ID]), np.array([1]))[0])

    def _is_plain(self) -> bool:
        """Whether letters and marks are pre-tokens of their own, lower-cased, and every one ends with a token that says so."""
        made = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
        split, level = ((made["pre_tokenizer"] or {}).get("pretokenizers", []) + [{}, {}])[:2]
        pattern = split.get("pattern", {}).get("Regex", "")
        apart = all(x in pattern.split("|") for x in (r"[\p{L}]+", r"[^\s\p{L}\p{N}]+")) and all(x.startswith(("'", "[")) for x in pattern.split("|"))
        return kinds == ["NFC", "Replace", "Lowercase"] and apart and level.get("type") == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"] and made["model"].get("end_of_word_suffix") == WORD_END

    def _append(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers of new runs of these lengths, laid end to end in ids."""
        end = int(self.stops[self.runs - 1])
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.runs + len(lengths) > len(self.stops):
            self.stops = np.concatenate([self.stops, np.zeros_like(self.stops)])
        self.ids[end : end + len(ids)] = ids
        first = self.runs
        self.runs += len(lengths)
        self.stops[first : self.runs] = end + np.cumsum(lengths)
        return np.arange(first, self.runs)

    def _gather(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs, end to end, and the length of each."""
        starts = self.stops[np.maximum(runs, 1) - 1]
        lengths = np.where(runs > 0, self.stops[runs] - starts, 0)
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
        return self.ids[at], lengths

    def _merged(self, words: pa.Array) -> np.ndarray:
        """New runs for words of letters; the merges mark where each one ends."""
        runs = [np.zeros(0, np.int64)]
        for k in range(0, len(words), ENCODE_AT_ONCE):
            ids = np.array(self.merges.encode_batch_fast([" ".join(words[k : k + ENCODE_AT_ONCE].to_pylist())], add_special_tokens=False)[0].ids, np.int64)
            runs.append(self._append(ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)))
        return np.concatenate(runs)

    def _whole(self, parts: pa.Array) -> np.ndarray:
        """New runs for parts of any kind."""
        runs = [np.zeros(0, np.int64)]
        for k in range(0, len(parts), ENCODE_AT_ONCE):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(parts[k : k + ENCODE_AT_ONCE].to_pylist(), add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            runs.append(self._append(np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())), lengths))
        return np.concatenate(runs)

    def _runs_of(self, kind: str, parts: pa.Array, encode) -> np.ndarray:
        """The run of each of parts; `encode` makes those of the parts that are not known."""
        different = parts.dictionary_encode()
        names, (known, runs) = different.dictionary, self.known[kind]
        at = pc.index_in(names, value_set=known)
        new = names.filter(at.is_null())
        found = np.empty(len(names), np.int64)
        is_new = at.is_null().to_numpy(zero_copy_only=False)
        found[~is_new] = runs[at.drop_null().to_numpy()]
        found[is_new] = made = encode(new)
        self.known[kind] = pa.concat_arrays([known, new]), np.concatenate([runs, made])
        return found[different.indices.to_numpy()]

    def _part_runs(self, parts: pa.Array) -> np.ndarray:
        """Two runs for each part, one after the other: letters and marks, or the part and nothing."""
        split = pc.extract_regex(parts, PLAIN_PART)
        easy = split.is_valid().to_numpy(zero_copy_only=False) & (self.merges is not None)
        runs = np.zeros(2 * len(parts), np.int64)
        some, at = split.filter(pa.array(easy)), np.flatnonzero(easy)
        runs[2 * at] = self._runs_of("letters", pc.utf8_lower(some.field("letters")), self._merged)
        runs[2 * at + 1] = self._runs_of("other", some.field("marks"), self._whole)
        runs[2 * np.flatnonzero(~easy)] = self._runs_of("other", parts.filter(pa.array(~easy)), self._whole)
        return runs

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, with END_ID after them."""
        split = pc.ascii_split_whitespace(texts)
        parts = split.flatten().dictionary_encode()
        if sum(len(known) for known, _ in self.known.values()) > CACHE_WORDS:
            self._clear()
        pairs = self._part_runs(parts.dictionary).reshape(-1, 2)[parts.indices.to_numpy()].ravel()
        stops = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        ids, lengths = self._gather(np.insert(pairs, 2 * stops, self.end))
        found = np.split(ids, np.cumsum(lengths)[2 * stops + np.arange(len(stops))][:-1]) if len(stops) else []
        for mark in self.special:
            for k in np.flatnonzero(pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)):
                found[k] = np.array([*self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, END_ID], "<u4")
        return found


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class OpenBins:
    """At most `limit` open bins of `capacity`, found by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.count, self.made = capacity, limit, 0, 0
        self.mask = 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        some = self.by_free[free]
        found = some.pop()
        if not some:
            self.mask &= ~(1 << free)
        self.count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for an item of 1 to capacity."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if self.count == self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)
            free, at = self.capacity, self.made
            self.made += 1
        if left := free - length:
            self.by_free.setdefault(left, []).append(at)
            self.mask |= 1 << left
            self.count += 1
        return at, self.capacity - free


def tokenized_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids (array<int>) if asked for."""
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, start // capacity, start, len(part), zlib.crc32(part), part))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    return docs.select(F.col("doc_id").cast("bigint"), filled().alias("text")).mapInArrow(pieces, schema)


def pack(pieces: DataFrame, tasks: int, capacity: int = CAPACITY, max_open: int = MAX_OPEN) -> DataFrame:
    """pieces with sequence_id and offset. Each task packs its share in a pseudorandom order that does not change."""
    order = F.xxhash64("doc_id", "piece")
    placed = pieces.withColumn("_order", order).repartition(tasks, "doc_id", "piece").sortWithinPartitions("_order", "doc_id", "piece", "length", "ids_crc32")
    names = pieces.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, max_open), TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [bins.place(n) for n in batch.column("length").to_pylist()]
            more = [pa.array([base + b for b, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, *more], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    return placed.drop("_order").mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, max_open: int = MAX_OPEN, with_ids: bool = False) -> DataFrame:
    """Every row of docs packed into sequences of at most `capacity` tokens; one row per piece."""
    tasks = groups_for(docs.count(), DOCS_PER_TASK)
    return pack(tokenized_pieces(docs, vocabulary, capacity, with_ids), tasks, capacity, max_open)

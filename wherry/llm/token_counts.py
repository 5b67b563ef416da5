"""Token counts with a whole-token shortcut for a byte-fallback BPE model of sentencepiece.

Offline, per worker, two facts are proved from the model's own pieces: no piece has the space mark after another
character, and no piece has a newline. Merges then never cross the start of a run of spaces nor a newline, so a text is the
concatenation of pre-tokens that can be counted apart. Every vocabulary string is then encoded alone; those that
come out as one token are the whole-token set. Pre-tokens in that set count one; only the rest are merged by the library,
each different one once while it stays in a bounded cache. Where a model lacks the two facts, whole texts go to the library.

Defined cases: a null text is the empty text (0 bytes, 0 tokens); one row per input row, repeated or null doc_id
included; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, slices

LIMIT = 4096
CACHE_PRETOKENS = 300_000
MARK = "▁"
#: A run of spaces with what follows up to the next space or newline, a run of spaces before a newline or the end, a newline.
PRETOKEN = re.compile(r" *[^ \n]+| +|\n")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        norm = proto.normalizer_spec
        normal = [p.piece for p in proto.pieces if p.type == p.NORMAL]
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        bpe = proto.trainer_spec.model_type == proto.trainer_spec.BPE and not any(p.type == p.USER_DEFINED for p in proto.pieces)
        self.separable = plain and bpe and not any(MARK in p.lstrip(MARK) or "\n" in p for p in normal)
        proto.normalizer_spec.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.single = self._prove([p.replace(MARK, " ") for p in normal]) if self.separable else frozenset()
        self.known: dict[str, int] = {}

    def _prove(self, surfaces: list[str]) -> frozenset[str]:
        """The vocabulary strings that are one pre-token and encode alone as one token."""
        encoded = self.part.encode(surfaces, num_threads=1)
        return frozenset(s for s, ids in zip(surfaces, encoded) if len(ids) == 1 and PRETOKEN.fullmatch(s))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self.whole.encode(text))
        pretokens = PRETOKEN.findall(f" {text}".replace(MARK, " "))
        rest = [p for p in pretokens if p not in self.single]
        if len(self.known) > CACHE_PRETOKENS:
            self.known = {}
        new = list({p for p in rest if p not in self.known})
        self.known.update(zip(new, map(len, self.part.encode(new, num_threads=1))))
        return len(pretokens) - len(rest) + sum(map(self.known.__getitem__, rest))


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One counter for each Python worker and model; the proof runs when it is made."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model).count
        for batch in slices(batches, "text"):
            n = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), filled().alias("text")).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    found = rows.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)

"""Byte-level BPE, encoded and decoded.

A text is cut at special tokens and by the tokenizer's pattern.  Within a word
the part boundaries and the rank of each pair of neighbours lie in two short
arrays: the least rank is sought, its boundary deleted, and the ranks beside it
refreshed, until no pair has a rank.  Long words, where that scan would grow
with the square, take the same merges from a heap.  Each worker keeps the
tokens of a bounded number of words, in two generations: those that come again
outlast the others.

The tokenizer's file is read by the driver and sent to the workers.

Defined cases: a null text encodes as an empty one (no tokens; both hashes are
those of the empty string); repeated rows encode alike.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import small_batches, table, unused

#: The byte-level pattern of the public tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of a word that is merged by scans, and words of a generation.
SHORT, KEPT = 48, 200_000
#: A pair of ids is one number, and so are the rank of its merge and the new id: ids have less than WIDTH bits.
WIDTH = 24
LOW, NONE = (1 << WIDTH) - 1, 1 << 60


def same_kind(spec: dict) -> None:
    """Raises where a tokenizer file asks for anything that is not built here."""
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    built = {
        "normalizer": spec.get("normalizer") is None, "post_processor": spec.get("post_processor") is None,
        "pre_tokenizer": cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True), "decoder": (spec.get("decoder") or {}).get("type") == "ByteLevel",
        "model": model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "added_tokens": not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    }
    if not all(built.values()):
        raise ValueError(f"not built for this tokenizer file: {sorted(k for k, ok in built.items() if not ok)}")


def load(path: str | None = None) -> dict:
    """Tables of a tokenizer file: merges by pair of ids, bytes by id, special tokens."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    same_kind(spec)
    # Byte-level files print each byte as one character: itself where that is printable, else the next from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ids = spec["model"]["vocab"]
    merges = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        merges[ids[a], ids[b]] = (rank, ids[a + b])
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {
        "merges": merges,
        "bytes": {i: bytes(byte_of[c] for c in t) for t, i in ids.items()} | {i: t.encode() for t, i in special.items()},
        "start": [ids[next(c for c, b in byte_of.items() if b == x)] for x in range(256)],
        "special": special,
    }


class Bpe:
    def __init__(self, tables: dict):
        self.merges, self.bytes, self.start, self.special = (tables[k] for k in ("merges", "bytes", "start", "special"))
        self.cuts = regex.compile(PATTERN)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pairs = {a << WIDTH | b: rank << WIDTH | new for (a, b), (rank, new) in self.merges.items()}
        self.known: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str, bytes]] = {}

    def short(self, parts: list[int]) -> list[int]:
        """Merges on two contiguous arrays: part ids and the ranks of neighbours."""
        rank = self.pairs.get
        ranks = [rank(a << WIDTH | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            parts[i] = new = best & LOW
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(new << WIDTH | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << WIDTH | new, NONE)
        return parts

    def long(self, parts: list[int]) -> list[int]:
        """The same merges with a heap and linked neighbours."""
        merges, n = self.merges, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], parts[i], parts[i + 1]) for i in range(n - 1) if (m := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if m := merges.get((new, parts[after[j]])):
                    heapq.heappush(heap, (m[0], i, m[1], new, parts[after[j]]))
            if (h := before[i]) >= 0 and (m := merges.get((parts[h], new))):
                heapq.heappush(heap, (m[0], h, m[1], parts[h], new))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> tuple[tuple[int, ...], str, bytes]:
        """Its ids, the ids in print, and the bytes that they decode to."""
        out = self.known.get(word) or self.older.get(word)
        if out is None:
            parts = [*map(self.start.__getitem__, word.encode("utf-8", "replace"))]
            size = len(parts)
            ids = tuple(self.short(parts) if size <= SHORT else self.long(parts))
            out = ids, ",".join(map(str, ids)), b"".join(map(self.bytes.__getitem__, ids))
            if size > SHORT:
                return out
        if len(self.known) >= KEPT:
            self.known, self.older = {}, self.known
        self.known[word] = out
        return out

    def pieces(self, text: str) -> list[tuple[tuple[int, ...], str, bytes]]:
        """What :meth:`word` gives for each word in turn."""
        known, word, cuts = self.known, self.word, self.cuts.findall
        if not self.marks or not self.marks.search(text):
            return [known.get(w) or word(w) for w in cuts(text)]
        out = []
        for part in self.marks.split(text):
            if part in self.special:
                i = self.special[part]
                out.append(((i,), str(i), self.bytes[i]))
            else:
                out += [known.get(w) or word(w) for w in cuts(part)]
        return out

    def encode(self, text: str | None) -> list[int]:
        return [i for ids, _, _ in self.pieces(text or "") for i in ids]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        found = self.pieces(text or "")
        n = sum([len(ids) for ids, _, _ in found])
        printed = ",".join([p for _, p, _ in found])
        back = b"".join([b for _, _, b in found]).decode("utf-8", "replace")
        return n, hashlib.sha256(printed.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


#: The encoder that this worker process made last, by the name of its tables.
_made: dict[str, Bpe] = {}


def digest_col(text: Column | str, spark: SparkSession, path: str | None = None) -> Column:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each text."""
    tables, name = spark.sparkContext.broadcast(load(path)), uuid.uuid4().hex

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        if name not in _made:
            _made.clear()
            _made[name] = Bpe(tables.value)
        return pd.DataFrame([_made[name].digest(t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` to doc_id and the three digest columns."""
    small_batches(docs.sparkSession, 500)
    return docs.select("doc_id", digest_col("text", docs.sparkSession, path).alias("d")).select("doc_id", "d.*")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the tokens themselves: an array of int in the first free name of ids, ids_, ..."""
    small_batches(docs.sparkSession, 500)
    tables, name = docs.sparkSession.sparkContext.broadcast(load(path)), uuid.uuid4().hex

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        if name not in _made:
            _made.clear()
            _made[name] = Bpe(tables.value)
        return pd.Series([_made[name].encode(t) for t in texts])

    return docs.withColumn(unused("ids", docs.columns), encoded("text"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: token digests of what is left."""
    return token_digests(docs.select("doc_id", "text"))

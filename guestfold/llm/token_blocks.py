"""Token ids in range-coded blocks, written and read back with Spark.

*Writing*: documents are range-partitioned and sorted by id, tokenised, and an end id is
appended to each.  The ids of a partition (a *shard*) form one stream, cut into blocks of
``BLOCK`` ids that are coded on their own (:mod:`guestfold.llm.rangecoder`).

*File format*: Parquet files of one row per block: shard, block (its number in the shard),
n_ids, plain_bits, crc32 (of the ids as little-endian unsigned 32-bit integers), code, and
pieces, the documents that have ids in the block: (doc_id, ordinal in the shard,
piece, n).  Spark's writer commits a task's file as a whole, so a lost
executor leaves no half block.  A block needs nothing but its row to be read: any task may decode it.

*Reading* decodes blocks wherever they lie, checks every checksum, and joins the pieces
of a document by its ordinal.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rangecoder as rc
from .common import Scratch, columns_as, text_batches, text_ids
from .pretokens import Splitter

END_ID = 2
#: Words whose ids a worker keeps.
CACHE_WORDS = 400_000


class _Words(dict):
    """Ids of words as little-endian 32-bit integers; those of a new word come from the library's model.

    The words used since half of CACHE_WORDS had come up are kept, and the half before them."""

    def __init__(self, model):
        self.model, self.older = model, {}

    def __missing__(self, word: str) -> bytes:
        own = self.older.get(word)
        if own is None:
            ids = [t.id for t in self.model.tokenize(Splitter.chars(word))]
            own = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = own
        return own

    def age(self) -> None:
        if 2 * len(self) > CACHE_WORDS:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which encodes every distinct word once.

    The words of a byte-level BPE file are encoded independently, so a text's ids are its words' ids in a
    row; a text with characters outside the splitter's safe set goes through the library whole."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.known = _Words(self.split.tokenizer.model)

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = self.split.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def encode(self, texts: list) -> list[bytes]:
        """Little-endian 32-bit ids of each text (null: none)."""
        out: list = [b""] * len(texts)
        odd: list[int] = []
        for i, text in enumerate(texts):
            if text:
                pieces = self.split.pieces(text)
                words, raw = self.split.words(text) if len(pieces) == 1 and not pieces[0][1] else ([], False)
                if raw:
                    self.known.age()
                    out[i] = b"".join(map(self.known.__getitem__, words))
                else:
                    odd.append(i)
        for i, ids in zip(odd, self._whole([texts[i] for i in odd])):
            out[i] = ids
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _blocks(frames, path: str, end_id: int) -> Iterator[tuple[np.ndarray, list[dict]]]:
    """Blocks of ids of a shard's documents in order, with their pieces."""
    e, end = encoder(path), np.array([end_id], "<u4").tobytes()
    held: list[bytes] = []
    pieces: list[dict] = []
    size, ordinal = 0, 0
    for f in text_batches(frames):
        for doc, ids in zip(f["id"].tolist(), e.encode(f["text"].tolist())):
            ids += end
            piece, at = 0, 0
            while at < len(ids):
                part = ids[at:at + 4 * (rc.BLOCK - size)]
                held.append(part)
                pieces.append({"doc_id": doc, "ordinal": ordinal, "piece": piece, "n": len(part) // 4})
                size, at, piece = size + len(part) // 4, at + len(part), piece + 1
                if size == rc.BLOCK:
                    yield np.frombuffer(b"".join(held), "<u4"), pieces
                    held, pieces, size = [], [], 0
            ordinal += 1
    if size:
        yield np.frombuffer(b"".join(held), "<u4"), pieces


def write_ids(df: DataFrame, out: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Write the ids of every text, ``end_id`` after each, in ascending order of ``id_col`` (nulls first, equal
    ids by a hash of their text) as coded blocks to the folder ``out``.

    Null and empty texts are just ``end_id``.  Repeated rows are written each.  Empty table: no blocks."""
    rows = columns_as(df, id=id_col, text=text_col)
    order = [F.col("id"), F.xxhash64("text")]

    def code(frames):
        shard, number, held = TaskContext.get().partitionId(), 0, []

        def coded():
            nonlocal number, held
            rows_ = [(shard, number + k, len(ids), bits, rc.crc32(ids), c, pieces)
                     for k, ((ids, pieces), (bits, c)) in enumerate(zip(held, rc.encode([ids for ids, _ in held])))]
            number, held = number + len(held), []
            return pd.DataFrame(rows_, columns=["shard", "block", "n_ids", "plain_bits", "crc32", "code", "pieces"])

        for block in _blocks(frames, path, end_id):
            held.append(block)
            if len(held) == rc.LANES:
                yield coded()
        if held:
            yield coded()

    rows, kind = text_ids(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    blocks = rows.mapInPandas(code, "shard int, block bigint, n_ids int, plain_bits int, crc32 bigint, code binary, "
                                    "pieces array<struct<doc_id:string,ordinal:bigint,piece:bigint,n:bigint>>")
    typed = F.transform("pieces", lambda p: p.withField("doc_id", p["doc_id"].cast(kind)))
    blocks.withColumn("pieces", typed).write.parquet(out)


def read_ids(spark: SparkSession, out: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, from the files of :func:`write_ids`: ``id_col``, start (ids of all documents before it), n_tokens (with the
    end id), ids_crc32 (unsigned, of its ids as little-endian unsigned 32-bit integers) and, with
    ``with_ids``, token_ids (those integers as binary).  A block whose ids don't fit its checksum raises an error."""
    blocks = spark.read.parquet(out)
    kind = blocks.select(F.col("pieces")[0]["doc_id"].alias("id")).schema["id"].dataType.simpleString()

    def pieces_of(frames):
        for f in frames:
            for at in range(0, len(f), rc.LANES):
                part = f.iloc[at:at + rc.LANES]
                out_ = []
                for r, ids in zip(part.itertuples(), rc.decode(list(zip(part["n_ids"], part["plain_bits"], part["code"])))):
                    raw = ids.astype("<u4").tobytes()
                    if rc.crc32(ids) != r.crc32:
                        raise ValueError(f"block {r.block} of shard {r.shard} doesn't fit its checksum")
                    start = 0
                    for p in r.pieces:
                        own = raw[4 * start:4 * (start + p["n"])]
                        out_.append((p["doc_id"], r.shard, p["ordinal"], p["piece"], r.block * rc.BLOCK + start, p["n"],
                                     rc.zlib.crc32(own), own if with_ids else None))
                        start += p["n"]
                yield pd.DataFrame(out_, columns=["id", "shard", "ordinal", "piece", "at", "n", "crc", "ids"])

    as_text = F.transform("pieces", lambda p: p.withField("doc_id", p["doc_id"].cast("string")))
    pieces = blocks.withColumn("pieces", as_text).mapInPandas(pieces_of, "id string, shard int, ordinal bigint, piece bigint, at bigint, n bigint, crc bigint, ids binary")
    pieces = pieces.withColumn("id", F.col("id").cast(kind))
    part = F.struct("piece", "n", "crc", *(["ids"] if with_ids else []))
    docs = pieces.groupBy("shard", "ordinal").agg(F.first("id").alias("id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
                                                  F.sort_array(F.collect_list(part)).alias("parts"))  # of one document

    @F.pandas_udf("bigint")
    def joined(ns: pd.Series, crcs: pd.Series) -> pd.Series:
        out_ = []
        for n, c in zip(ns, crcs):
            total = int(c[0])
            for k in range(1, len(n)):
                total = rc.crc32_join(total, int(c[k]), 4 * int(n[k]))
            out_.append(total)
        return pd.Series(out_, dtype="int64")

    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row a writing task
    bases = shards.alias("s").select("shard", F.expr("coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0)").alias("base"))
    docs = docs.join(F.broadcast(bases), "shard")
    crc = F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(joined(F.col("parts.n"), F.col("parts.crc")))
    extra = [F.expr("aggregate(parts.ids, binary(''), (a, x) -> concat(a, x))").alias("token_ids")] if with_ids else []
    return docs.select(F.col("id").alias(id_col), (F.col("base") + F.col("at")).alias("start"), "n_tokens", crc.alias("ids_crc32"), *extra)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """:func:`write_ids` to a new folder under ``spark.checkpoint.dir``, then :func:`read_ids`."""
    out = f"{Scratch(df.sparkSession).root}/ids"
    write_ids(df, out, path, id_col, text_col)
    return read_ids(df.sparkSession, out, id_col, with_ids)

"""Token ids in binary blocks.

Ids are ranked by how often they occur in the corpus, and the ranks are written in byte-aligned
codes of variable length: two bits of a control byte say how many bytes (1 to 4) each of four
ranks takes, and control bytes stand apart from data bytes (Stream VByte; Lemire et al., 2018).
Frequent ids take one byte. numpy decodes by looking up the lengths of the four codes of a control
byte in a table.

A block holds whole documents in order of doc_id and describes itself:

    magic "TVB1", uint32 documents, uint64 tokens, uint64 data bytes, uint32 crc32 of what follows
    int64 doc_id of each document (the smallest int64: null), uint64 tokens of each
    control bytes, ceil(tokens / 4); the last is filled with zeros
    data bytes, little-endian

all little-endian. Blocks are rows of a Parquet table (shard, block, before, documents, tokens, first and
last doc_id, data; before counts the tokens of the shard's earlier blocks), written by Spark's committer, so that a lost executor leaves no half-written
file and any store that Spark writes to will do. Beside them stands the table of ranks.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

HEAD = struct.Struct("<4sIQQI")
MAGIC = b"TVB1"
NULL = -(1 << 63)
#: For each control byte: the lengths of its four codes.
LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3) + 1).astype(np.uint8)
NARROW = np.array([0, 0xFF, 0xFFFF], np.uint16)
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_block(values: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A block of all documents' values (uint32), counts of them a document, with doc_ids (int64)."""
    n = len(values)
    narrow = n == 0 or int(values.max()) <= 0xFFFF  # codes of one or two bytes only
    values = np.concatenate([values.astype(np.uint16 if narrow else np.uint32), np.zeros(-n % 4, np.uint16)])
    size = (values > 0xFF).astype(np.uint8)
    if not narrow:
        size += (values > 0xFFFF).astype(np.uint8) + (values > 0xFFFFFF)
    four = size.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    width = 2 if narrow else 4
    data = values[:n].astype(f"<u{width}").view(np.uint8).reshape(-1, width)[np.arange(width, dtype=np.uint8) <= size[:n, None]]
    body = ids.astype("<i8").tobytes() + counts.astype("<u8").tobytes() + control.tobytes() + data.tobytes()
    return HEAD.pack(MAGIC, len(counts), n, len(data), zlib.crc32(body)) + body


def decode_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, counts, doc_ids) of a block; ValueError if it is damaged."""
    magic, docs, n, size, crc = HEAD.unpack_from(block)
    if magic != MAGIC or zlib.crc32(memoryview(block)[HEAD.size :]) != crc:
        raise ValueError("damaged block")
    ids = np.frombuffer(block, "<i8", docs, HEAD.size)
    counts = np.frombuffer(block, "<u8", docs, HEAD.size + 8 * docs)
    control = np.frombuffer(block, np.uint8, -(-n // 4), HEAD.size + 16 * docs)
    data = np.frombuffer(block, np.uint8, size, HEAD.size + 16 * docs + len(control))
    length = LENGTHS[control].ravel()[:n]
    at = np.cumsum(length, dtype=np.int64) - length
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    if (control & 0xAA).any():
        words = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
        return (words[at] & MASKS[length - 1]).astype(np.uint32), counts, ids
    words = np.ndarray((len(data) + 1,), "<u2", padded, strides=(1,))  # no code of over two bytes
    return words[at] & NARROW[length], counts, ids


def letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a character: printable ones of Latin-1 as themselves,
    the others as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


LETTERS = letters()


def kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


#: White space that a text cut into pieces does not have.
OTHER_SPACE = re.compile(r"[^\S \n]")


class Odd(Exception):
    """A piece holds other white space than single blanks and line ends."""


#: Marks that a word may end in; white space, letters and digits are none.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Pieces(dict):
    """A number for each piece of a text; ids[borders[i] : borders[i + 1]] are those of piece i. New
    pieces are cut into pre-tokens, which go through the library's model."""

    def __init__(self, tokenizer, code: str):
        self.model, self.cut, self.code = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str, code
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.borders = array(self.code), array("q", [0])

    def __missing__(self, x: str) -> int:
        if x.isalpha() or x[:1] == " " and x[1:].isalpha():
            self.word(x.replace(" ", LETTERS[32]) if x.isascii() else x.encode().decode("latin-1").translate(LETTERS))
        else:
            if OTHER_SPACE.search(x):
                raise Odd
            y = x.rstrip(MARKS)
            if len(y) < len(x) and (y.isalpha() or y[:1] == " " and y[1:].isalpha()):
                self.united(y, x[len(y) :])
            else:
                parts = self.cut(x)
                if len(parts) == 1:
                    self.word(parts[0][0])
                else:
                    self.united(*[x[a:b] for _, (a, b) in parts])
        self.borders.append(len(self.ids))
        self[x] = found = len(self.borders) - 2
        return found

    def word(self, w: str) -> None:
        """Ids of a pre-token, written as the model has it."""
        self.ids.extend([t.id for t in self.model.tokenize(w)])

    def united(self, *parts: str) -> None:
        for i in [self[p] for p in parts]:
            self.ids.extend(self.ids[self.borders[i] : self.borders[i + 1]])


class Encoder:
    """Ids of texts by the tokenizers library, each distinct piece of a text encoded once.

    Byte-level BPE with its own pattern works on pieces that no merge crosses. A text whose white
    space is single spaces and line ends, between other signs, is cut before every space and around
    every line end, which are borders of such pieces. Arrow cuts the texts of a batch and finds their
    distinct pieces; new ones go through the library's model, and the ids of all texts are put
    together by numpy. Every other text (other white space is seen when its piece is new, and such
    pieces are never kept), every text that holds an added token, and every other kind of tokenizer,
    goes through encode() whole."""

    MOST = 700_000  # pieces kept; then the table starts anew
    BYTES = 4 << 20  # of texts taken at once; a longer text is taken by itself

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        p = str(self.t.pre_tokenizer)
        self.simple = p.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in p and self.t.normalizer is None and type(self.t.model).__name__ == "BPE"
        added = [x.content for x in self.t.get_added_tokens_decoder().values()]
        self.odd = "|".join([r"[ \n][ \n]", r"^[ \n]", r"[ \n]$", r"\x00", *[re.sub(r"(\W)", r"\\\1", x) for x in added if x]])
        self.kind = kind(self.t.get_vocab_size())
        self.pieces = Pieces(self.t, {"<u2": "H", "<u4": "I"}[self.kind]) if self.simple else None

    def close(self) -> None:
        """Gives up the pieces, as a worker process goes on to tasks of other operators."""
        import pyarrow as pa

        if self.simple:
            self.pieces.clear()
        pa.default_memory_pool().release_unused()

    def whole(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids, little-endian, of the narrowest kind that the vocabulary allows."""
        import pyarrow as pa

        return self.batch(pa.array([text], pa.string()), None)[0].as_py()

    def batches(self, texts, end: int | None):
        """Arrow arrays of the ids of texts, each with the end id, as binary; a null is as empty."""
        import pyarrow.compute as pc

        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.BYTES, "right")))
            yield self.batch(texts[at:upto], end)
            at = upto

    def batch(self, texts, end: int | None):
        import pyarrow as pa
        import pyarrow.compute as pc

        texts, tail = pc.fill_null(texts, ""), b"" if end is None else np.array([end], self.kind).tobytes()
        if not self.simple:
            return pa.array([self.whole(x) + tail for x in texts.to_pylist()], pa.binary())
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(plain, " ", "\x00 "), "\n", "\x00\n\x00"), "\x00")
        coded = lists.flatten().dictionary_encode()
        borders, codes = lists.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy()
        borders -= borders[0]
        if len(self.pieces) > self.MOST:
            self.pieces.clear()
        found, strange = np.empty(len(coded.dictionary), np.int64), []
        for i, x in enumerate(coded.dictionary.to_numpy(zero_copy_only=False)):
            try:
                found[i] = self.pieces[x]
            except Odd:
                found[i] = self.pieces[""]
                strange.append(i)
        if strange:
            odd = odd | (np.add.reduceat(np.isin(codes, strange), borders[:-1]) > 0)
        size = np.dtype(self.kind).itemsize
        ids, start = np.frombuffer(self.pieces.ids, self.kind), np.frombuffer(self.pieces.borders, np.int64)
        length = start[found + 1] - start[found]
        start, each = start[found], length[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(start[codes] - upto[:-1], each)
        at += np.arange(len(at))
        out, ends = ids[at], upto[borders]
        if end is not None:
            out = np.insert(out, ends[1:], end)
            ends = ends + np.arange(len(ends))
        data, ends = out.tobytes(), ends * size
        if not odd.any():
            return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
        own = texts.to_pylist()
        return pa.array([self.whole(own[i]) + tail if odd[i] else data[ends[i] : ends[i + 1]] for i in range(len(own))], pa.binary())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, which serves many tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenize(docs: DataFrame, path: str, end: int | None) -> DataFrame:
    """doc_id and each text's ids as binary (see Encoder), with the end id; null is as empty."""

    def of(batches):
        import pyarrow as pa

        e = encoder(path)
        for b in batches:
            at = 0
            for ids in e.batches(b.column(1), end):
                yield pa.RecordBatch.from_arrays([b.column(0)[at : at + len(ids)], ids], ["doc_id", "ids"])
                at += len(ids)
        e.close()

    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary")


def frequencies(ids: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all rows of ids; each task counts first and sends a row for each id it saw."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for p in batches:
            c = np.bincount(flat(p.column(0), dtype)[0])
            if len(c) > len(total):
                c, total = total, c
            total[: len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def flat(column, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of an Arrow column of binary one after the other, and where each row's end."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    ids = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(dtype) if data is not None and len(column) else np.zeros(0, dtype)
    return ids, (ends[1:] - ends[0]) // np.dtype(dtype).itemsize


def ranking(ids: DataFrame, dtype: str) -> np.ndarray:
    """Ids by falling frequency, ties by id. There are at most as many as the vocabulary has."""
    rows = frequencies(ids, dtype).orderBy(F.desc("n"), "id").select("id").collect()
    return np.array([r[0] for r in rows], np.uint32)


def write(spark: SparkSession, docs: DataFrame, out: str, path: str, end: int | None = 0, doc_id: str = "doc_id", text: str = "text", tokens: int = 1 << 20, partitions: int | None = None) -> None:
    """Writes out/blocks and out/ranks from the texts of docs, in ascending order of doc_id
    (null first; equal ids by their tokens). Null texts are as empty. A block is closed once it
    has `tokens` tokens. An empty table gives a file without blocks. Columns besides doc_id and
    text are ignored, whatever they are named."""
    import pyarrow as pa

    scratch = Scratch(spark, "tokens")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids = scratch.table(tokenize(own, path, end), "ids")
    dtype = encoder(path).kind
    by_rank = ranking(ids, dtype)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def blocks(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        shard, block, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def one():
            values, counts, names = (np.concatenate(x) for x in zip(*held))
            first, last = (None if x == NULL else int(x) for x in (names[0], names[-1]))
            row = (shard, block, before, len(names), len(values), first, last, encode_block(rank[values], counts, names))
            return pa.RecordBatch.from_pylist([dict(zip(BLOCK.names, row))], BLOCK)

        for p in batches:
            names = pc.fill_null(p.column(0), NULL).to_numpy(zero_copy_only=False)
            ids, ends = flat(p.column(1), dtype)
            at, begin = 0, 0
            while at < len(names):
                upto = int(np.searchsorted(ends, begin + tokens - size)) + 1  # the row that fills the block
                part = slice(at, min(upto, len(names)))
                end = int(ends[part.stop - 1])
                held.append((ids[begin:end], np.diff(ends[part], prepend=begin), names[part]))
                size += end - begin
                at, begin = part.stop, end
                if size >= tokens:
                    yield one()
                    held, size, block, before = [], 0, block + 1, before + size
        if held:
            yield one()

    BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), *((n, pa.int64()) for n in ("before", "documents", "tokens", "first_id", "last_id")), ("data", pa.binary())])
    # ranges are of doc_ids alone: what the sampler sends to the driver are keys, never token ids
    spread = ids.repartitionByRange(*([partitions] if partitions else []), "doc_id").sortWithinPartitions("doc_id", "ids")
    made = spread.mapInArrow(blocks, "shard int, block int, before long, documents long, tokens long, first_id long, last_id long, data binary")
    made.write.option("compression", "none").parquet(f"{out}/blocks")
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank int, id long").coalesce(1).write.parquet(f"{out}/ranks")
    scratch.drop()


def offsets(spark: SparkSession, out: str) -> DataFrame:
    """The blocks of a file with start, the number of tokens before each: those of its shard, and
    the totals of the shards before, one row a shard. Blocks themselves are not shuffled unless
    there are more shards than a task should hold."""
    blocks = spark.read.parquet(f"{out}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("tokens").alias("t"))
    ahead = F.coalesce(F.sum("t").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = totals.select(F.col("shard").alias("s"), ahead.alias("ahead"))
    few = totals.count() <= 100_000
    joined = blocks.join(F.broadcast(ahead) if few else ahead, F.col("shard") == F.col("s"))
    return joined.withColumn("start", F.col("ahead") + F.col("before")).drop("s", "ahead")


def read(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start (the number of tokens of all documents before it) and ids (binary,
    little-endian uint32) of each document of a file."""
    by_rank = np.array([r[0] for r in spark.read.parquet(f"{out}/ranks").orderBy("rank").select("id").collect()], "<u4")

    def docs(batches):
        import pyarrow as pa

        for p in batches:
            for start, data in zip(p.column(0).to_pylist(), p.column(1).to_pylist()):
                values, counts, names = decode_block(data)
                ids = by_rank[values] if len(values) else np.zeros(0, "<u4")
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                for at in range(0, len(counts), 4096):
                    e = ends[at : at + 4097]
                    part = pa.Array.from_buffers(pa.binary(), len(e) - 1, [None, pa.py_buffer(((e - e[0]) * 4).astype(np.int32)), pa.py_buffer(ids[e[0] : e[-1]].tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 4096]), pa.array(start + e[:-1]), part], ["doc_id", "start", "ids"])

    return offsets(spark, out).select("start", "data").mapInArrow(docs, "doc_id long, start long, ids binary").withColumn("doc_id", F.nullif("doc_id", F.lit(NULL)))


def encode_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Writes docs and reads the file back: doc_id, start, n_tokens, ids_crc32 of each document."""
    import public_tokenizers

    out = Scratch(spark, "token-file").path
    write(spark, docs, out, **{"path": public_tokenizers.path("byte_bpe_50k.json"), "end": 0} | options)
    return read(spark, out).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_token_ids": op5}
SQL: dict[str, str] = {}

"""Archives of token ids: binary files with one shared zstandard dictionary.

An archive is a folder with
  `dictionary`  a table of one row: the dictionary and its SHA-256,
  `shards`      the binary files,
  `manifest`    a table with a row per shard, written last; readers follow it alone, so files
                of lost or repeated tasks are never read.

A shard: the 8 bytes `TIFFTOK1`, the SHA-256 of the dictionary (32 bytes), then one zstandard
frame for each document, made with the dictionary, then the index, then its length (8 bytes,
little-endian) and `TIFFTOK1` again. A frame holds the ids of one document as little-endian
unsigned integers of 2 or 4 bytes, whichever the vocabulary needs. The index is an Arrow stream
with the columns id, offset, n_tokens and first (ids before the document in this shard), so one
document is read with two short reads, and its frame is decompressed alone.

The frames are made before documents are put in ascending order of their id, so the range
exchange moves them compressed. The dictionary is trained in one task on a bounded sample:
windows of at most SAMPLE_BYTES of SAMPLE_DOCS documents chosen by a hash. It changes sizes only,
never what is read.

Defined results: a null or empty text has the end id alone. Null ids come last; rows of one id
are ordered by their ids' hash, equal rows by nothing more, since they cannot be told apart.
An empty table gives an archive without shards. A very long text is one frame; one document is
the unit of memory. Other columns are not carried on, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import ragged, slices
from tiffin.llm.token_counts import _blanks, _separators
from tiffin.llm.units import LATIN, model_ids
from tiffin.session import remove_path, work_path

MAGIC = b"TIFFTOK1"
SAMPLE_DOCS = 2048
SAMPLE_BYTES = 4096
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 64 << 20
SHARD_DOCS = 1 << 20
LEVEL = 3
STORE_WORDS = 800_000
STORE_IDS = 8_000_000
LEARN_AT_ONCE = 20_000
SLICE_BYTES = 2 << 20
READERS = 20_000
BATCH_IDS = 1 << 21
# Latin letters between ASCII marks other than the apostrophe: the tokenizer parts them too.
_marks = r"[!-&(-/:-@\[-`{-~]*"
_marked = re.compile(f"({_marks})([{LATIN}]+)({_marks})")


class WordEncoder:
    """The library's ids, word by word; words seen before come from a bounded store.

    Blanks separate words and leave no token, and neither the normaliser nor special tokens
    reach across one, which is checked when the file is read.
    """

    def __init__(self, data: bytes):
        # Spark runs one task a core; threads of the library would only compete.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(data)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if (
            [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]
            or steps[0]["type"] != "Split" or not steps[0]["invert"]
            or steps[0]["behavior"] != "Removed" or steps[1]["type"] != "ByteLevel"
            or steps[1]["add_prefix_space"] or spec["truncation"] or spec["padding"]
            or any(
                t["lstrip"] or t["rstrip"] or t["normalized"] or len(t["content"].split()) != 1
                for t in spec["added_tokens"]
            )
        ):
            raise ValueError("this kind of tokenizer file is not supported")
        # What all special tokens begin with; without letters it has no case. An empty one is
        # part of every text, so that nothing is changed or parted.
        self.mark = os.path.commonprefix([t["content"] for t in spec["added_tokens"]])
        if self.mark.lower() != self.mark.upper():
            self.mark = ""
        self.library = Tokenizer.from_str(data.decode())
        self.model = self.library.model
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        """The words of a text; in lower case if that cannot make a difference, which leaves
        fewer different ones."""
        if text.isascii() and self.mark not in text:
            text = text.lower()
        return _blanks.split(text) if _separators.search(text) else text.split()

    def _hold(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        begin = len(self.index)
        self.index.update(zip(words, range(begin, begin + len(words)), strict=True))
        self.starts = np.concatenate((self.starts, np.cumsum(sizes) - sizes + len(self.flat)))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, flat))

    def _learn(self, words: list[str]) -> None:
        """Hold new words; those of letters between marks as what their parts are held as."""
        found = list(map(_marked.fullmatch, words))
        split = {
            w: [part for part in m.groups() if part]
            for w, m in zip(words, found, strict=True) if m and (m[1] or m[3]) and self.mark not in w
        }
        parts = [part for chosen in split.values() for part in chosen]
        fresh = dict.fromkeys([w for w in words if w not in split])
        fresh.update(dict.fromkeys([part for part in parts if part not in self.index]))
        whole = list(fresh)
        for at in range(0, len(whole), LEARN_AT_ONCE):
            some = whole[at : at + LEARN_AT_ONCE]
            # Lower case is all that the normaliser makes of Latin letters, one by one.
            forms = model_ids(self.model, [w if w.islower() else w.lower() for w in some])
            others = [i for i, form in enumerate(forms) if form is None]
            coded = self.library.encode_batch_fast(
                [some[i] for i in others], add_special_tokens=False
            )
            for i, form in zip(others, coded, strict=True):
                forms[i] = form.ids
            sizes = np.fromiter(map(len, forms), np.int64, len(forms))
            flat = np.fromiter(chain.from_iterable(forms), np.uint32, int(sizes.sum()))
            self._hold(some, flat, sizes)
        if split:
            rows = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
            sizes = self.sizes[rows]
            flat = self.flat[ragged(self.starts[rows], sizes)]
            ends = np.cumsum(np.fromiter(map(len, split.values()), np.int64, len(split)))
            self._hold(list(split), flat, np.diff(np.cumsum(sizes)[ends - 1], prepend=0))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        if len(self.index) > STORE_WORDS or len(self.flat) > STORE_IDS:
            self._clear()
        parts = list(map(self.words, texts))
        words = list(chain.from_iterable(parts))
        rows = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([words[i] for i in missing])))
            rows[missing] = [self.index[words[i]] for i in missing]
        sizes = self.sizes[rows]
        ids = self.flat[ragged(self.starts[rows], sizes)]
        per_text = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(per_text)]
        return ids, np.diff(ends, prepend=0)


_encoders: dict[bytes, WordEncoder] = {}


def encoder_of(data: bytes) -> WordEncoder:
    """The encoder, made once per Python process."""
    if data not in _encoders:
        _encoders[data] = WordEncoder(data)
    return _encoders[data]


def _encoding(spark: SparkSession, tokenizer_path: str, end_id: int | None):
    """The step from (id, text) to (id, width, ids)."""
    # The file is of fixed size, about two megabytes.
    data = spark.sparkContext.broadcast(Path(tokenizer_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value)
        width = encoder.width if end_id is None or end_id < 1 << 16 else 4
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, sizes = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            if end_id is not None:
                out = np.full(len(ids) + len(sizes), end_id, np.uint32)
                begins = np.cumsum(sizes + 1) - sizes - 1
                out[ragged(begins, sizes)] = ids
                ids, sizes = out, sizes + 1
            raw = ids.astype(f"<u{width}").tobytes()
            ends = (np.cumsum(sizes) * width).tolist()
            column = [raw[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(np.full(len(sizes), width, np.int32)),
                    pa.array(column, pa.binary()),
                ],
                ["id", "width", "ids"],
            )

    return run


def _packing(spark: SparkSession, dictionary: bytes, level: int):
    """The step from (id, width, ids) to (id, width, n_tokens, place, frame)."""
    # At most DICTIONARY_BYTES.
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary_of(shared.value))
        for batch in batches:
            raw = batch.column("ids").to_pylist()
            widths = np.asarray(batch.column("width")).astype(np.int64)
            sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // widths
            places = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("width"), pa.array(sizes),
                    pa.array(places.view(np.int64)),
                    pa.array(list(map(compressor.compress, raw)), pa.binary()),
                ],
                ["id", "width", "n_tokens", "place", "frame"],
            )

    return run


def _schema(id_type: T.DataType, packed: bool) -> T.StructType:
    fields = [T.StructField("id", id_type), T.StructField("width", T.IntegerType(), False)]
    if packed:
        fields += [T.StructField(n, T.LongType(), False) for n in ("n_tokens", "place")]
    return T.StructType(
        [*fields, T.StructField("frame" if packed else "ids", T.BinaryType(), False)]
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def encode(
    docs: DataFrame, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, width, ids): the little-endian ids of each row, `end_id` after each document."""
    return _texts(docs, id_col, text_col).mapInArrow(
        _encoding(docs.sparkSession, tokenizer_path, end_id),
        _schema(docs.schema[id_col].dataType, False),
    )


def pack(encoded: DataFrame, dictionary: bytes, level: int = LEVEL) -> DataFrame:
    """(id, width, n_tokens, place, frame): the ids of each row as one zstandard frame, and a
    hash of them that orders rows of one id."""
    return encoded.select("id", "width", "ids").mapInArrow(
        _packing(encoded.sparkSession, dictionary, level),
        _schema(encoded.schema["id"].dataType, True),
    )


def encode_packed(
    docs: DataFrame, tokenizer_path: str, dictionary: bytes, end_id: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL,
) -> DataFrame:
    """`pack` of `encode` in one Python process a task."""
    first = _encoding(docs.sparkSession, tokenizer_path, end_id)
    then = _packing(docs.sparkSession, dictionary, level)
    return _texts(docs, id_col, text_col).mapInArrow(
        lambda batches: then(first(batches)), _schema(docs.schema[id_col].dataType, True)
    )


def sampled(rows: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """About `sample_docs` rows, never more than twice as many; chosen by the hash of a row."""
    total = rows.count()
    if total <= 2 * sample_docs:
        return rows
    place = F.xxhash64(*rows.columns)
    some = rows.where(place < int(sample_docs / total * (1 << 63)) * 2 - (1 << 63))
    return some.orderBy(place).limit(2 * sample_docs)


def train_dictionary(
    encoded: DataFrame, sample_bytes: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES
) -> bytes:
    """A zstandard dictionary of at most `size` bytes, from a window of each of the given rows.

    The rows go through one task: give a sample. Too few to train on serve as the dictionary
    themselves; without any it is empty.
    """
    place = F.xxhash64("ids")
    windows = F.greatest(F.ceil(F.length("ids") / sample_bytes).cast("long"), F.lit(1))
    first = F.pmod(place, windows) * sample_bytes + 1
    window = F.col("ids").substr(first.cast("int"), F.lit(sample_bytes))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(w for batch in batches for w in batch.column("window").to_pylist() if w)
        try:
            dictionary = zstandard.train_dictionary(size, held).as_bytes()
        except (zstandard.ZstdError, ValueError):
            dictionary = b"".join(held)[-size:]
        yield pa.RecordBatch.from_arrays([pa.array([dictionary], pa.binary())], ["dictionary"])

    row = encoded.select(window.alias("window")).repartition(1).mapInArrow(
        train, "dictionary binary"
    ).first()
    return bytes(row["dictionary"]) if row else b""


def dictionary_of(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class ShardWriter:
    """One file, frame by frame."""

    def __init__(self, folder: str, digest: bytes):
        # A name of its own for each attempt: a repeated task never meets half a file.
        self.name = f"{uuid.uuid4().hex}.tok"
        system, base = fs.FileSystem.from_uri(folder)
        self.out = system.open_output_stream(f"{base}/{self.name}")
        self.out.write(MAGIC + digest)
        self.at = len(MAGIC) + 32
        self.ids: list = []
        self.offsets: list[int] = []
        self.counts: list[int] = []

    def add(self, id_, frame: bytes, n_tokens: int) -> None:
        self.out.write(frame)
        self.ids.append(id_)
        self.offsets.append(self.at)
        self.counts.append(n_tokens)
        self.at += len(frame)

    def close(self, id_type: pa.DataType, width: int) -> tuple:
        counts = np.array(self.counts, np.int64)
        index = pa.table(
            {
                "id": pa.array(self.ids, id_type),
                "offset": pa.array(self.offsets, pa.int64()),
                "n_tokens": pa.array(counts),
                "first": pa.array(np.cumsum(counts) - counts),
            }
        ).replace_schema_metadata({"width": str(width)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as writer:
            writer.write_table(index)
        data = sink.getvalue().to_pybytes()
        self.out.write(data + len(data).to_bytes(8, "little") + MAGIC)
        self.out.close()
        size = self.at + len(data) + 8 + len(MAGIC)
        return self.name, len(counts), int(counts.sum()), size


class Shard:
    """Short access to the documents of one file."""

    def __init__(self, path: str, dictionary: bytes):
        system, base = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(base)
        size = self.file.size()
        head, tail = self.file.read_at(len(MAGIC) + 32, 0), self.file.read_at(16, size - 16)
        if head[: len(MAGIC)] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{path} is no complete shard")
        if head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary")
        length = int.from_bytes(tail[:8], "little")
        self.frames_end = size - 16 - length
        with pa.ipc.open_stream(self.file.read_at(length, self.frames_end)) as stream:
            self.index = stream.read_all()
        self.width = int(self.index.schema.metadata[b"width"])
        self.offsets = np.append(
            np.asarray(self.index.column("offset")), self.frames_end
        ).astype(np.int64)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=dictionary_of(dictionary))

    def __len__(self) -> int:
        return self.index.num_rows

    def ids(self, place: int) -> np.ndarray:
        """The ids of the document at a place of the index; nothing else is decompressed."""
        lo, hi = int(self.offsets[place]), int(self.offsets[place + 1])
        raw = self.decompressor.decompress(self.file.read_at(hi - lo, lo))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def batches(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first place, ids of documents from there on), in order, some millions of ids each."""
        counts = np.asarray(self.index.column("n_tokens"))
        block = np.cumsum(counts) // BATCH_IDS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(counts)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            begin = int(self.offsets[lo])
            data = self.file.read_at(int(self.offsets[hi]) - begin, begin)
            ends = (self.offsets[lo : hi + 1] - begin).tolist()
            yield lo, [
                np.frombuffer(self.decompressor.decompress(data[a:b]), f"<u{self.width}")
                .astype("<u4") for a, b in zip(ends, ends[1:], strict=False)
            ]

    def close(self) -> None:
        self.file.close()


def write(
    packed: DataFrame, path: str, dictionary: bytes, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write an archive from rows of `pack`, in ascending order of their id.

    `path` is a folder that all executors share and that Arrow can open (a local or mounted
    path, or a store it knows).
    """
    spark = packed.sparkSession
    digest = hashlib.sha256(dictionary).digest()
    spark.range(1, numPartitions=1).select(
        F.lit(digest).alias("sha256"), F.lit(dictionary).alias("dictionary")
    ).write.parquet(f"{path}/dictionary")
    folder = f"{path}/shards"
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    frames_path = work_path(spark, "frames")
    packed.write.parquet(frames_path)
    frames = spark.read.schema(packed.schema).parquet(frames_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        writer = id_type = width = None

        def finish() -> pa.RecordBatch:
            row = (part, shard, *writer.close(id_type, width))
            names = ["part", "shard", "name", "n_docs", "n_tokens", "n_bytes"]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])

        for batch in batches:
            id_type = batch.schema.field("id").type
            rows = zip(
                *[batch.column(n).to_pylist() for n in ("id", "width", "frame", "n_tokens")],
                strict=True,
            )
            for id_, size, frame, n_tokens in rows:
                if writer is not None and (
                    size != width or writer.at >= shard_bytes or len(writer.ids) >= SHARD_DOCS
                ):
                    yield finish()
                    writer, shard = None, shard + 1
                if writer is None:
                    writer, width = ShardWriter(folder, digest), size
                writer.add(id_, frame, n_tokens)
        if writer is not None:
            yield finish()

    order = [F.col("id").isNull(), F.col("id"), F.col("place")]
    (
        frames.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(
            run,
            "part long, shard long, name string, n_docs long, n_tokens long, n_bytes long",
        )
        .write.parquet(f"{path}/manifest")
    )
    remove_path(spark, frames_path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard, with `start`, the ids in all shards before it.

    The sum runs in two steps: over the shards of each part, and over the parts, of which there
    are as many as tasks wrote.
    """
    shards = spark.read.parquet(f"{path}/manifest")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"),
    )
    return shards.join(parts, F.col("part") == F.col("of_part")).select(
        *shards.columns,
        (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .alias("start"),
    )


def read(
    spark: SparkSession, path: str, id_type: T.DataType | None = None
) -> DataFrame:
    """(id, start, n_tokens, ids): every document of the archive and the ids before it.

    `ids` are little-endian unsigned integers of 4 bytes.
    """
    row = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast(bytes(row["dictionary"]))
    shards = manifest(spark, path)
    schema = T.StructType(
        [
            T.StructField("id", id_type or T.LongType()),
            T.StructField("start", T.LongType(), False),
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("ids", T.BinaryType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(f"{path}/shards/{row['name']}", shared.value)
                first = np.asarray(shard.index.column("first")) + row["start"]
                for lo, documents in shard.batches():
                    hi = lo + len(documents)
                    yield pa.RecordBatch.from_arrays(
                        [
                            shard.index.column("id").slice(lo, hi - lo).combine_chunks(),
                            pa.array(first[lo:hi]),
                            pa.array([len(d) for d in documents], pa.int64()),
                            pa.array([d.tobytes() for d in documents], pa.binary()),
                        ],
                        schema.names,
                    )
                shard.close()

    # Rows of the manifest are short, the files behind them are not: a task for each, so that
    # adaptive execution does not put them together by the size of their rows.
    tasks = max(1, min(READERS, shards.count()))
    return shards.select("name", "start").repartition(tasks, "name").mapInArrow(run, schema)


def archived(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode, write and read back: the rows of `read`."""
    some = sampled(_texts(docs, id_col, text_col))
    dictionary = train_dictionary(encode(some, tokenizer_path, end_id, "id", "text"))
    write(encode_packed(docs, tokenizer_path, dictionary, end_id, id_col, text_col), path, dictionary)
    return read(docs.sparkSession, path, docs.schema[id_col].dataType)

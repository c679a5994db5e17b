"""SentencePiece encoding and decoding by vectorised merge rounds.

The model's pieces become a pair table; the words of a batch of texts are merged together by
`merge_rounds.merge`, and words seen before come from a bounded store. Supported are BPE models
with byte fallback and without character normalisation, which is checked when a model is read.

Defined results: a null text counts as empty; an empty text has no ids and decodes to an empty
text. Each input row gives one output row, equal rows equal ones. Other columns of the input
are not carried on, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import ragged, slices
from tiffin.llm.merge_rounds import Pairs, WordStore, merge

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
UNKNOWN_TEXT = " ⁇ "
# Arrays over a slice take tens of bytes for each of its letters, in every task of an executor.
SLICE_BYTES = 1 << 20
BLOCK_IDS = 1 << 16
_runs = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class Model:
    """A SentencePiece BPE model as arrays."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        trainer, rules = proto.trainer_spec, proto.normalizer_spec
        kinds = np.array([p.type for p in proto.pieces])
        if (
            trainer.model_type != BPE or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces or not rules.escape_whitespaces
            or not rules.add_dummy_prefix
            or not set(kinds.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("only plain BPE models with byte fallback are supported")
        texts = [p.piece for p in proto.pieces]
        normal = {t: i for i, t in enumerate(texts) if kinds[i] == NORMAL}
        if any(BLANK in t.lstrip(BLANK) for t in normal):
            raise ValueError("a piece spans two words")

        # Symbols are piece ids; letters that are no piece of their own come after them.
        letters = {c for t in normal for c in t}
        symbol = dict(normal)
        for letter in sorted(letters - set(normal)):
            symbol[letter] = len(texts) + len(symbol) - len(normal)
        self.n_pieces = len(texts)
        # A letter outside the vocabulary is kept as -1 - code point.
        self.of_letter = -1 - np.arange(0x110000, dtype=np.int32)
        for letter in letters:
            self.of_letter[ord(letter)] = symbol[letter]
        self.letter_of = {symbol[c]: ord(c) for c in letters}

        scores = {normal[t]: proto.pieces[normal[t]].score for t in normal}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rows = [
            (symbol[t[:k]], symbol[t[k:]], order[scores[i]], i)
            for t, i in normal.items()
            for k in range(1, len(t))
            if t[:k] in symbol and t[k:] in symbol
        ]
        self.pairs = Pairs(*zip(*rows, strict=True), max(symbol.values()) + 1)

        self.byte_id = np.zeros(256, np.int32)
        spelled: list[bytes] = []
        for i, text in enumerate(texts):
            if kinds[i] == BYTE:
                value = int(text[1:-1], 16)
                self.byte_id[value] = i
                spelled.append(bytes([value]))
            elif kinds[i] == CONTROL:
                spelled.append(b"")
            elif kinds[i] == UNKNOWN:
                spelled.append(UNKNOWN_TEXT.encode())
            else:
                spelled.append(text.replace(BLANK, " ").encode())
        self.is_byte = kinds == BYTE
        self.blank_first = np.array([t.startswith(BLANK) for t in texts]) & (kinds == NORMAL)
        self.is_control = kinds == CONTROL
        self.spelled = spelled
        self.out_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.out_sizes = np.array([len(b) for b in spelled], np.int64)
        self.out_starts = np.cumsum(self.out_sizes) - self.out_sizes
        self.period = self._blank_period()
        self.store = WordStore(self._encode_words)

    # ---- encoding

    def _blank_period(self) -> int:
        """The length of the blocks that long runs of blanks fall into, 0 if there is none."""
        sizes = np.arange(1, 129)
        blank = self.of_letter[ord(BLANK)]
        flat, counts = merge(self.pairs, np.full(int(sizes.sum()), blank), sizes)
        forms = np.split(flat, np.cumsum(counts)[:-1])
        for period in range(1, 33):
            head = forms[period - 1]
            if len(head) == 1 and all(
                np.array_equal(forms[n - 1], np.concatenate((head, forms[n - period - 1])))
                for n in range(2 * period, 129)
            ):
                return period
        return 0

    def segments(self, text: str) -> list[str]:
        """Parts of a text that no piece crosses.

        A part that begins with one blank is given without it; parts that begin with more keep
        all of them. Long runs of blanks are cut into the blocks they merge to.
        """
        if not text:
            return []
        if BLANK not in text and "  " not in text and text[0] != " ":
            return text.split(" ")
        parts: list[str] = []
        for part in _runs.findall(BLANK + text.replace(" ", BLANK)):
            blanks = len(part) - len(part.lstrip(BLANK))
            if blanks == 1:
                parts.append(part[1:])
                continue
            cut = max(0, blanks // self.period - 3) * self.period if self.period else 0
            if cut:
                parts.extend([BLANK * self.period] * (cut // self.period))
            parts.append(part[cut:])
        return parts

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        full = [w if w.startswith(BLANK) else BLANK + w for w in words]
        sizes = np.fromiter(map(len, full), np.int64, len(full))
        letters = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
        flat, sizes = merge(self.pairs, self.of_letter[letters], sizes)
        return self._spell_unknown(flat, sizes)

    def _spell_unknown(self, flat, sizes):
        """Replace what is no piece by the byte pieces of its UTF-8 form."""
        odd = np.flatnonzero((flat < 0) | (flat >= self.n_pieces))
        if not len(odd):
            return flat, sizes
        points = [
            -1 - s if s < 0 else self.letter_of[s] for s in flat[odd].tolist()
        ]
        forms = [chr(p).encode() for p in points]
        widths = np.ones(len(flat), np.int64)
        widths[odd] = [len(f) for f in forms]
        out = np.repeat(flat, widths)
        at = ragged((np.cumsum(widths) - widths)[odd], widths[odd])
        out[at] = self.byte_id[np.frombuffer(b"".join(forms), np.uint8)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return out, np.bincount(owner, weights=widths, minlength=len(sizes)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        parts = [self.segments(t) for t in texts]
        rows = self.store.lookup([p for part in parts for p in part])
        starts, sizes = self.store.starts[rows], self.store.sizes[rows]
        ids = self.store.flat[ragged(starts, sizes)]
        per_text = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(per_text)]
        return ids, np.diff(ends, prepend=0)

    # ---- decoding

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each sequence of ids; bytes that are no UTF-8 become U+FFFD each."""
        blocks = (ids[at : at + BLOCK_IDS] for at in range(0, len(ids), BLOCK_IDS))
        data = b"".join(
            self.out_bytes[ragged(self.out_starts[block], self.out_sizes[block])].tobytes()
            for block in blocks
        )
        places = np.concatenate(([0], np.cumsum(self.out_sizes[ids])))
        ends = np.cumsum(sizes)
        controls = self.is_control[ids]
        texts: list[str | None] = []
        for lo, hi in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
            begin = int(places[lo])
            first = lo
            while first < hi and self.is_control[ids[first]]:
                first += 1
            # The blank put before the first word goes again.
            if first < hi and self.blank_first[ids[first]]:
                begin += 1
            raw = data[begin : places[hi]]
            try:
                # Bytes on both sides of a control piece do not belong together.
                texts.append(raw.decode() if not controls[lo:hi].any() else None)
            except UnicodeDecodeError:
                texts.append(None)
            if texts[-1] is None:
                texts[-1] = self._decode_bytewise(ids[lo:hi].tolist(), first - lo)
        return texts

    def _decode_bytewise(self, ids: list[int], first: int) -> str:
        out: list[str] = []
        run = bytearray()
        for place, i in enumerate([*ids, -1]):
            if i >= 0 and self.is_byte[i]:
                run += self.spelled[i]
                continue
            while run:
                for width in range(1, 5):
                    try:
                        out.append(bytes(run[:width]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    width = 1
                del run[:width]
            if i >= 0:
                text = self.spelled[i].decode()
                out.append(text[1:] if place == first and self.blank_first[i] else text)
        return "".join(out)


_models: dict[bytes, Model] = {}


def model_of(data: bytes) -> Model:
    """The model, read once per Python process."""
    if data not in _models:
        _models[data] = Model(data)
    return _models[data]


def _model_data(df: DataFrame, model_path: str):
    """The model file, half a megabyte of fixed size, for all executors."""
    return df.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
    decoded: bool = False, store_words: int = 400_000,
) -> DataFrame:
    """(id, ids array<int>) per row, with `decoded` also the text that the ids decode to.

    `store_words` bounds the words that a task keeps for later ones; it changes no result."""
    data = _model_data(docs, model_path)
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    ]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(data.value)
        model.store.limit = store_words
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, sizes = model.encode(texts)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            columns = [batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(ids))]
            if decoded:
                columns.append(pa.array(model.decode(ids, sizes), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, T.StructType(fields)
    )


def decode(
    rows: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "ids"
) -> DataFrame:
    """(id, text) per row of token ids; a null list of ids, or a null in it, counts as nothing."""
    data = _model_data(rows, model_path)
    schema = T.StructType(
        [
            T.StructField("id", rows.schema[id_col].dataType),
            T.StructField("text", T.StringType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(data.value)
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
            texts = model.decode(np.asarray(lists.flatten()).astype(np.int64), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string())], ["id", "text"]
            )

    ids = F.coalesce(F.array_compact(F.col(ids_col)), F.array().cast("array<int>"))
    return rows.select(F.col(id_col).alias("id"), ids.alias("ids")).mapInArrow(run, schema)

"""SentencePiece encoding that keeps source offsets, and decoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, text_slices, with_fields

SPACE_MARK = "▁"
MODEL = "piece_bpe_32k.model"


class CharMap:
    """Longest-prefix rewriting with the compiled character map of a model.

    The blob is: trie size in bytes, a double-array trie of 32-bit units, then the replacement texts, each
    ended by a zero byte. A leaf holds the place of its replacement.
    """

    def __init__(self, blob: bytes) -> None:
        self.units: list[int] = []
        self.first = np.zeros(256, bool)
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.texts = blob[4 + size:]
            root = self._step(0, self.units[0])
            for byte in range(256):
                at = root ^ byte
                self.first[byte] = at < len(self.units) and self.units[at] & 0x800000FF == byte

    @staticmethod
    def _step(at: int, unit: int) -> int:
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def longest(self, raw: bytes, start: int) -> tuple[int, bytes]:
        """Length of the longest key that begins at ``start``, and its replacement; 0 if there is none."""
        length, value, units = 0, 0, self.units
        at = self._step(0, units[0])
        for i in range(start, len(raw)):
            at ^= raw[i]
            unit = units[at]
            if unit & 0x800000FF != raw[i]:
                break
            at = self._step(at, unit)
            if unit >> 8 & 1:
                length, value = i + 1 - start, units[at] & 0x7FFFFFFF
        return length, self.texts[value:self.texts.index(b"\0", value)] if length else b""

    def rewrite(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The rewritten bytes, and for each of them (and the end) the source offset it comes from."""
        source = np.frombuffer(raw, np.uint8)
        if not self.units or not self.first[source].any():
            return raw, np.arange(len(raw) + 1)
        out, origin, at, n = bytearray(), [], 0, len(raw)
        while at < n:
            taken, text = self.longest(raw, at) if self.first[raw[at]] else (0, b"")
            if taken:
                out += text
                origin += [at] * len(text)
            else:
                lead = raw[at]
                taken = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                out += raw[at:at + taken]
                origin += range(at, at + taken)
            at += taken
        return bytes(out), np.array([*origin, n], np.int64)


class Codec:
    """Normalises with alignment, segments with the model's merges, and projects pieces to source spans."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        rules = spec.normalizer_spec
        if not spec.trainer_spec.byte_fallback or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("needs a model with byte fallback and leading word marks")
        if not rules.escape_whitespaces:
            raise ValueError("needs a model that escapes spaces")
        self.chars = CharMap(rules.precompiled_charsmap)
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        # The segmenter gets text that is already normalised.
        rules.Clear()
        rules.name, rules.add_dummy_prefix, rules.remove_extra_whitespaces = "identity", False, False
        spec.denormalizer_spec.Clear()
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.end_id = self.decoder.eos_id()
        self.piece_bytes = np.array(
            [1 if p.type == 6 else 0 if p.type == 3 else len(p.piece.encode()) for p in spec.pieces], np.int64)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the byte offset in the source."""
        raw, origin = self.chars.rewrite(text.encode())
        flat = np.frombuffer(raw, np.uint8)
        if self.squeeze and len(flat):
            keep = ~((flat == 32) & np.concatenate([[True], flat[:-1] == 32]))
            end = int(np.flatnonzero(keep & (flat != 32)).max(initial=-1)) + 1
            keep[end:] = False
            raw, flat = flat[keep].tobytes(), flat[keep]
            origin = np.concatenate([origin[:-1][keep], origin[-1:]])
        if not len(flat):
            return "", origin[-1:]
        width = np.where(flat == 32, 3, 1)
        aligned = np.concatenate([np.repeat(origin[:-1], width), origin[-1:]])
        marked = raw.decode().replace(" ", SPACE_MARK)
        if self.prefix:
            marked, aligned = SPACE_MARK + marked, np.concatenate([np.full(3, origin[0]), aligned])
        return marked, aligned

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids with the end id, and the source byte span [begin, end) of every id.

        The end id spans nothing. A byte piece spans its own byte where the character was not rewritten.
        """
        normal = [self.normalise(t) for t in texts]
        pieces = self.segmenter.encode([n for n, _ in normal], num_threads=1)
        out = []
        for found, (_, aligned) in zip(pieces, normal):
            ids = np.array([*found, self.end_id], np.int32)
            ends = np.cumsum(self.piece_bytes[ids])
            if ends[-1] != len(aligned) - 1:
                raise ValueError("pieces do not cover the normalised text")
            begins = np.concatenate([[0], ends[:-1]])
            out.append((ids, aligned[begins].astype(np.int32), aligned[ends].astype(np.int32)))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decoder.decode(ids)


_CODECS: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec per Python worker and model."""
    if model not in _CODECS:
        _CODECS[model] = Codec(model)
    return _CODECS[model]


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; by default the public 32k piece model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as file:
        return file.read()


def encode_decode(df: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ids, begins, ends (arrays; byte offsets in the source text) and decoded.

    NULL is encoded as the empty text, whose only id is the end id. Every row gives one row, repeated or not.
    """
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch, texts in text_slices(batches, "__text"):
            coded = coder.encode(texts)
            offsets = pa.array(np.cumsum([0, *(len(c[0]) for c in coded)]), pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([c[i] for c in coded]), pa.int32()))
                      for i in range(3)]
            decoded = pa.array([coder.decode(c[0].tolist()) for c in coded], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), *arrays, decoded],
                names=[*batch.schema.names[:-1], "ids", "begins", "ends", "decoded"])

    kept = df.select(*keep, F.col(text).alias("__text"))
    return kept.mapInArrow(run, with_fields(
        kept.schema.fields[:-1], "ids array<int>, begins array<int>, ends array<int>, decoded string"))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded rows; ``source_bytes`` is where the last span ends."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.element_at("ends", -1).alias("source_bytes"))


def op1_sentencepiece(spark, sf_dir):
    """Every document encoded and decoded."""
    return digests(encode_decode(documents(spark, sf_dir), model_bytes()))


QUERIES = {"op1_sentencepiece": op1_sentencepiece}

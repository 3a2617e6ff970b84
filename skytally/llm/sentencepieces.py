"""SentencePiece models on the tokenizers library.

The model file is read field by field, and normaliser, metaspace mark, pieces with their scores
and byte fallback are rebuilt as a tokenizer of that library, which encodes whole batches on
several threads. Each worker compares its first texts with the sentencepiece library itself.
"""

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import boxed

MARK = "▁"
_CHECKED = 32
_GROUP_CHARS = 1 << 18
_DECODED = 50

# Field numbers and values of the model format. Fixed values.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _BYTE_FALLBACK, _UNK_ID = 3, 35, 40
_CHARSMAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 2, 3, 4, 5
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message, in order."""

    def varint(at):
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 2, 5):
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = message[at : at + size], at + size
        else:
            raise ValueError(f"field of kind {kind} in a model file")
        yield tag >> 3, value


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, kind
    kind: int = _UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape: bool = True


def parse(data: bytes) -> PieceModel:
    """What the tokenizer needs of a serialised model."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == _PIECES:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece[1].decode(), score, piece.get(3, _NORMAL)))
        elif number == _TRAINER:
            trainer = dict(_fields(value))
            model.kind = trainer.get(_MODEL_TYPE, _UNIGRAM)
            model.byte_fallback = bool(trainer.get(_BYTE_FALLBACK, 0))
            model.unk_id = trainer.get(_UNK_ID, 0)
        elif number == _NORMALIZER:
            spec = dict(_fields(value))
            model.charsmap = spec.get(_CHARSMAP, b"")
            model.dummy_prefix = bool(spec.get(_DUMMY_PREFIX, 1))
            model.remove_extra_spaces = bool(spec.get(_EXTRA_SPACES, 1))
            model.escape = bool(spec.get(_ESCAPE, 1))
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """All ways to join two pieces to a third, the best third first."""
    known = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind == _NORMAL}
    found = []
    for text, number in known.items():
        score = model.pieces[number][1]
        for cut in range(1, len(text)):
            left, right = text[:cut], text[cut:]
            if left in known and right in known:
                found.append((-score, number, known[left], known[right], (left, right)))
    return [pair for *_, pair in sorted(found)]


def build(model: PieceModel):
    """A tokenizer of the tokenizers library that does what the model says."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if not model.escape or any(kind == _USER_DEFINED for *_, kind in model.pieces):
        raise ValueError("models with user-defined pieces or plain spaces are not supported")
    if model.kind == _BPE:
        vocabulary = {text: i for i, (text, *_) in enumerate(model.pieces)}
        core = models.BPE(
            vocabulary,
            _merges(model),
            unk_token=model.pieces[model.unk_id][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    elif model.kind == _UNIGRAM:
        scored = [(text, score) for text, score, _ in model.pieces]
        core = models.Unigram(scored, model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is not supported")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK)] if model.dummy_prefix else []
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    texts = [text for text, _, kind in model.pieces if kind == _NORMAL]
    if not any(MARK in text.lstrip(MARK) for text in texts):
        # No piece goes on over a mark, so words can be encoded, and remembered, one by one.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *ends]
    )
    return tokenizer


class Pieces:
    """A model by its file, with both libraries."""

    def __init__(self, path: str, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        self.tokenizer = build(parse(data))
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.checked = 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        some = max(0, _CHECKED - self.checked)
        self.checked += len(texts[:some])
        for text, ids in zip(texts[:some], found):
            if ids != self.reference.encode(text):
                raise ValueError(f"the libraries differ on {text[:200]!r}")
        return found

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


_models: dict[str, Pieces] = {}


def pieces(path: str, threads=2) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path, threads)
    return _models[path]


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Batches of bounded size; a long text may be one of its own."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= _GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str, threads=2, text="text") -> DataFrame:
    """Every document with ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``.

    Columns: doc (struct of the other columns), text, ids, n_tokens. A null or empty text has
    no ids; marks like ``<s>`` in a text are ordinary characters. Empty tables give no rows.
    """
    rows = boxed(docs, text)
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.BinaryType())])

    def run(batches):
        model = pieces(path, threads)
        for batch in batches:
            ids = []
            for group in _groups(batch.column("text").to_pylist()):
                ids += [np.asarray(i, "<u4").tobytes() for i in model.encode(group)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary())], ["doc", "text", "ids"]
            )

    encoded = rows.mapInArrow(run, schema)
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(rows: DataFrame, path: str, ids="ids") -> DataFrame:
    """The rows of :func:`encode`, without the text, with ``decoded`` made from the ids. Null
    ids give an empty text."""
    kept = rows.select("doc", "n_tokens", ids)
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        model = pieces(path)
        for batch in batches:
            texts = []
            # Lists of numbers take far more room than their bytes: few at a time.
            for at in range(0, len(batch), _DECODED):
                some = batch.column(ids)[at : at + _DECODED].to_pylist()
                texts += model.decode([np.frombuffer(i or b"", "<u4").tolist() for i in some])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], schema.names
            )

    return kept.mapInArrow(run, schema)

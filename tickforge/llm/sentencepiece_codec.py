"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model protobuf is read field by field and rebuilt as a ``tokenizers.Tokenizer``: the
normaliser (compiled character map, dummy prefix, white-space rules), the metaspace marker, the
pieces with their unigram scores (or, for a BPE model, the merges that the scores imply) and byte
fallback. ``encode_documents`` encodes whole texts in batches on several threads and decodes them
again; ``parity`` compares ids with the ``sentencepiece`` library.

Defined cases: NULL and empty texts have no ids and round-trip to the empty text; control pieces
(such as ``<s>``) written in a text are ordinary characters; a text that holds the marker U+2581
itself, or that the model's normaliser changes, has ``round_trip`` false; repeated rows are
encoded each; a text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import map_texts, texts_of

MARKER = "▁"
# Fixed values of the public model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words that go to the library at once.
BATCH_WORDS = 4_096
#: Characters of a word, on average, beyond which fewer words are remembered.
WORD_CHARS = 16


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message; bytes for length-delimited ones."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, data[at : at + size]
            at += size


def parse_model(data: bytes) -> Model:
    """The parts of a SentencePiece model file that encoding needs."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.squeeze_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    return model


def build_tokenizer(model: Model):
    """The model as a ``tokenizers.Tokenizer``."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        merges = []
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind == NORMAL:
                merges += [(-score, i, k, piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in vocab and piece[k:] in vocab]
        merges.sort()
        core = models.BPE(vocab=vocab, merges=[m[3:] for m in merges], unk_token=model.pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    mark = MARKER if model.escape_spaces else " "
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    # Where no piece has the marker behind another character, no token crosses from one word to
    # the next, and words can be cut apart beforehand (and cached).
    if model.escape_spaces and not any(re.search(f"[^{MARKER}]{MARKER}", p) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+"), "isolated")
    back = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(back)
    own = [AddedToken(p, normalized=False, special=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens(own)
    return out


class Codec:
    """A tokenizer built from model bytes; one a task.

    Where no piece has the marker behind another character, no token crosses from one word to the
    next: then only the words not met before go to the library, in batches on ``threads`` threads,
    and a text's ids are those of its words. Twice ``cached_words`` words are remembered at most
    (or twice ``WORD_CHARS`` times as many characters, where words are long), and those of one batch."""

    def __init__(self, data: bytes, threads: int = 2, cached_words: int = 200_000):
        import os

        from tokenizers import normalizers

        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        model = parse_model(data)
        self.tokenizer = build_tokenizer(model)
        self.normalizer = self.tokenizer.normalizer
        own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
        crossing = any(re.search(f"[^{MARKER}]{MARKER}", p) for p, _, kind in model.pieces if kind == NORMAL)
        self.by_word = model.escape_spaces and not crossing and not own
        # Lines part words too, unless a piece holds a line feed.
        self.word = _WORD if any("\n" in p for p, _, kind in model.pieces if kind == NORMAL) else _WORD_OR_LINE
        self.plain = not model.charsmap and not model.squeeze_spaces and model.dummy_prefix
        if self.by_word:
            self.tokenizer.normalizer = normalizers.Sequence([])
        # Ids (as int32) of the words met, and of those of the turn before; markers are spaces here.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # What a word of these decodes to, if that is not the word itself.
        self.other: dict[str, str] = {}
        self.held = 0
        self.cached_words = cached_words
        self.prefix = model.dummy_prefix
        # What a piece reads as by itself; None for bytes that need their neighbours.
        self.shown: list[str | None] = []
        self.raw: list[bytes] = []
        for piece, _, kind in model.pieces:
            byte = int(piece[3:5], 16) if kind == BYTE else -1
            self.raw.append(bytes([byte]) if byte >= 0 else piece.replace(MARKER, " ").encode())
            self.shown.append(piece.replace(MARKER, " ") if byte < 0 else chr(byte) if byte < 128 else None)

    def _split(self, text: str) -> list[str]:
        """The words of the normalised text, with spaces for its markers (no space is left in it)."""
        if self.plain:
            text = " " + text if text else text
        else:
            text = self.normalizer.normalize_str(text)
        return self.word.findall(text.replace(MARKER, " "))

    def encode(self, texts: list[str]) -> list[list[int]]:
        flat, ends, _ = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in one array, where each text's ids end, and the texts decoded from them."""
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            flat = np.fromiter((x for row in ids for x in row), dtype=np.int32)
            return flat, np.cumsum([0, *map(len, ids)]), self.decode(ids)
        split = [self._split(t) for t in texts]
        if len(self.words) > self.cached_words or self.held > WORD_CHARS * self.cached_words:
            # Words met since the last turn stay for one more; the others are forgotten.
            self.older, self.words, self.held = self.words, {}, 0
            self.other = {w: text for w, text in self.other.items() if w in self.older}
        known, older = self.words, self.older
        new = list({w for words in split for w in words if w not in known})
        self.held += sum(map(len, new))
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in known]
        # What the library tells of a word takes far more room than its ids.
        for at in range(0, len(new), BATCH_WORDS):
            some = new[at : at + BATCH_WORDS]
            for word, e in zip(some, self.tokenizer.encode_batch_fast([w.replace(" ", MARKER) for w in some], add_special_tokens=False)):
                ids = e.ids
                known[word] = array("i", ids).tobytes()
                text = self._word_text(ids)
                if text != word:
                    self.other[word] = text
        parts, back, other = [], [], self.other
        for words in split:
            parts.append(b"".join([known[w] for w in words]))
            # Bytes of a character stay within a word, so a text reads as its words do.
            text = "".join([other.get(w, w) for w in words] if other else words)
            back.append(text[1:] if self.prefix and text[:1] == " " else text)
        return np.frombuffer(b"".join(parts), dtype=np.int32), np.cumsum([0, *map(len, parts)]) // 4, back

    def _word_text(self, ids: list[int]) -> str:
        """What the ids of one word read as, its leading space included."""
        try:
            return "".join([self.shown[x] for x in ids])
        except TypeError:
            raw = b"".join([self.raw[x] for x in ids])
        try:
            return raw.decode()
        except UnicodeDecodeError:
            text = self.tokenizer.decode(ids, skip_special_tokens=False)
            return " " + text if self.prefix and raw[:1] == b" " else text

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of id lists; lists with bytes beyond ASCII go through the library's decoder."""
        out: list[str | None] = []
        for row in ids:
            try:
                text = "".join([self.shown[x] for x in row])
                out.append(text[1:] if self.prefix and text[:1] == " " else text)
            except TypeError:
                out.append(None)
        rest = [i for i, text in enumerate(out) if text is None]
        for i, text in zip(rest, self.tokenizer.decode_batch([ids[i] for i in rest], skip_special_tokens=False)):
            out[i] = text
        return out


_WORD = re.compile(" +[^ ]*|[^ ]+")
_WORD_OR_LINE = re.compile(" +[^ \n]*|[^ \n]+|\n+")


def parity(data: bytes, texts: list[str]) -> list[bool]:
    """For each text, whether the ids equal those of the sentencepiece library."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    return [a == b for a, b in zip(Codec(data, 1).encode(texts), theirs.encode(texts, num_threads=1))]


def encode_documents(docs: DataFrame, model: bytes, *, threads: int = 2) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 (of the ids as little-endian int32), round_trip."""
    # A model file is bounded by its vocabulary (0.5 MB here), whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ready: list[Codec] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Codec(shared.value, threads))
        texts = texts_of(batch)
        flat, ends, back = ready[0].encode_flat(texts)
        sizes = np.diff(ends)
        digest = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), pa.array(digest), pa.array([a == b for a, b in zip(texts, back)])],
            ["doc_id", "n_tokens", "ids", "ids_sha256", "round_trip"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, round_trip boolean")


def decode_documents(encoded: DataFrame, model: bytes, *, threads: int = 2) -> DataFrame:
    """doc_id and the decoded text of rows with ``ids`` (NULL ids: the empty text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    ready: list[Codec] = []

    def run(batches):
        for batch in batches:
            if not ready:
                ready.append(Codec(shared.value, threads))
            texts = ready[0].decode([x or [] for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")

"""SentencePiece BPE encoding and decoding without running merges per text.

A merge-type (BPE) encoding is the one sequence of pieces in which every
adjacent pair is *compatible*: re-merging the two pieces' text gives the same
two pieces. So the encoding is found by backtracking instead of merging: one pass
of an Aho-Corasick automaton over the text, along its failure links, gives the
longest piece that starts at each position; it
is tried first; a piece stays if it is compatible with its predecessor and
does not end at a position already known to have no valid continuation (one
bit per position); otherwise the next shorter piece is tried, and when none is
left the position's bit is set and the previous piece is shortened.

Defined results: null or empty text has no ids and decodes to the empty
string; null ids decode to the empty string. Rows are mapped one to one, so
repeated rows, ties and extra columns pass through; existing columns named
like an output are replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from airlake.llm.common import add_columns, texts_of

SPACE = "▁"
NO_MERGE = float("-inf")
#: Entries of a worker's caches: of chunks in each of two generations, and of pairs.
CACHE_ENTRIES = 300_000
PAIR_ENTRIES = 1_000_000
#: Longer chunks are encoded each time instead of cached.
CACHED_CHARS = 64


class PieceModel:
    """Vocabulary tables of a BPE model with byte fallback."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb2

        proto = pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kinds = proto.normalizer_spec, pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != pb2.TrainerSpec.BPE:
            raise ValueError("only BPE (merge-type) models are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normalizer are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space as a suffix is not supported")
        if {p.type for p in proto.pieces} & {kinds.USER_DEFINED, kinds.UNUSED}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        # decoding: bytes of every id; control pieces give nothing
        self.surface = [
            b"" if p.type == kinds.CONTROL
            else proto.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN
            else bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE
            else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        # a piece that merging its own characters does not produce never occurs
        self.reachable = {i for p, i in self.ids.items() if self.remerge(p) == [p]}
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        # text may be cut before a run of spaces if no piece goes on past one
        self.cuts_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.cuts_at_newline = "\n" not in inner

    def remerge(self, text: str) -> list[str]:
        """The merges of the model on ``text``: best score first, then leftmost."""
        score, parts = self.score.get, list(text)
        scores = [score(a + b, NO_MERGE) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > NO_MERGE:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NO_MERGE)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NO_MERGE)
        return parts

    def chunk_pattern(self) -> re.Pattern:
        if not self.cuts_at_space:
            return re.compile(r"(?s).+")
        if self.cuts_at_newline:
            return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Encoder:
    """Backtracking encoder: an automaton, the next shorter piece of every
    piece, and bounded caches. A Python worker keeps it between tasks."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        #: piece id: the longest piece that is a proper prefix of it, -1 if none
        self.shorter: dict[int, int] = {}
        self.length = [len(p) for p in model.pieces]
        words = {p: i for p, i in model.ids.items() if i in model.reachable}
        for piece, i in words.items():
            self.automaton.add_word(piece, i)
            best = -1
            for end in range(1, len(piece)):
                best = words.get(piece[:end], best)
            self.shorter[i] = best
        self.automaton.make_automaton()
        self.letters = frozenset(p for p in model.ids if len(p) == 1)
        self.split = model.chunk_pattern().findall
        self.by_word = model.dummy_prefix and model.cuts_at_space and model.cuts_at_newline
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        #: by left piece: whether a right piece is compatible
        self.pairs: list[dict[int, bool]] = [{} for _ in model.pieces]
        self.known_pairs = 0

    def compatible(self, left: int, right: int) -> bool:
        if self.known_pairs >= PAIR_ENTRIES:
            self.known_pairs = 0
            for row in self.pairs:
                row.clear()
        self.known_pairs += 1
        a, b = self.model.pieces[left], self.model.pieces[right]
        fits = self.pairs[left][right] = self.model.remerge(a + b) == [a, b]
        return fits

    def longest_matches(self, text: str) -> list[int]:
        """The longest piece that starts at each position, -1 if none."""
        longest, length = [-1] * len(text), self.length
        for last, piece in self.automaton.iter(text):  # by end: longer ones come later
            longest[last + 1 - length[piece]] = piece
        return longest

    def span(self, text: str) -> list[int]:
        """Ids of a text whose characters all are pieces."""
        size, length, shorter, pairs = len(text), self.length, self.shorter, self.pairs
        longest = self.longest_matches(text)
        failed = None  # bit field of positions, made when the first one fails
        ids: list[int] = []
        at, after = 0, None  # after: what is known to fit behind the last piece
        piece = longest[0]
        while at < size:
            while piece >= 0:
                end = at + length[piece]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if after is None:
                        break
                    fits = after.get(piece)
                    if self.compatible(ids[-1], piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                at, after = end, pairs[piece]
                if at < size:
                    piece = longest[at]
            else:
                if not ids:
                    raise ValueError("no encoding: the model's pieces do not cover its characters")
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                dropped = ids.pop()
                at -= length[dropped]
                after = pairs[ids[-1]] if ids else None
                piece = shorter[dropped]
        return ids

    def chunk(self, text: str) -> bytes:
        """int32 ids of a chunk; characters outside the vocabulary become bytes."""
        return self.remembered(text, text, self.chunks)

    def word(self, word: str) -> bytes:
        return self.remembered(word, word if word[:1] == "\n" else SPACE + word, self.words)

    def remembered(self, key: str, text: str, cache: dict[str, bytes]) -> bytes:
        ids = array("i", self.span(text)) if self.letters.issuperset(text) else self.mixed(text)
        out = ids.tobytes()
        if len(text) <= CACHED_CHARS:
            if len(cache) >= CACHE_ENTRIES:
                cache.clear()
            cache[key] = out
        return out

    def mixed(self, text: str) -> array:
        ids, at = array("i"), 0
        for i, c in enumerate(text):
            if c not in self.letters:
                if at < i:
                    ids.extend(self.span(text[at:i]))
                ids.extend([self.model.byte_ids[b] for b in c.encode()])
                at = i + 1
        if at < len(text):
            ids.extend(self.span(text[at:]))
        return ids

    def encode(self, text: str) -> bytes:
        """int32 ids of a whole text."""
        if not text:
            return b""
        if self.by_word and "  " not in text and text[0] != " " and SPACE not in text:
            # without runs of spaces a chunk is a word, or a line break and
            # the word behind it; both are found by splitting at spaces
            chunks, get, code = text.replace("\n", " \n").split(" "), self.words.get, self.word
        else:
            marked = (SPACE + text if self.model.dummy_prefix else text).replace(" ", SPACE)
            chunks, get, code = self.split(marked), self.chunks.get, self.chunk
        return b"".join([get(c) or code(c) for c in chunks])


class Decoder:
    def __init__(self, model: PieceModel):
        self.surface = np.array(model.surface, dtype=object)
        self.is_byte = np.zeros(len(model.surface), dtype=bool)
        self.is_byte[model.byte_ids] = True
        self.strips = model.dummy_prefix
        self.unk = model.unk
        self.silent = np.array([not s for s in model.surface])

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids. Runs of byte pieces form UTF-8; each byte that is
        not part of a valid character gives one replacement character. The
        space of the dummy prefix (the first piece's) is dropped."""
        if not len(ids):
            return ""
        parts = self.surface[ids]
        spoken = np.flatnonzero(~self.silent[ids])
        if self.strips and len(spoken) and not self.is_byte[ids[spoken[0]]] and ids[spoken[0]] != self.unk:
            parts[spoken[0]] = parts[spoken[0]].removeprefix(b" ")
        try:
            if len(spoken) < len(ids):
                raise UnicodeDecodeError("utf-8", b"", 0, 0, "control pieces")
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            # control pieces, which say nothing, end a run of bytes
            runs = np.split(parts, np.flatnonzero(self.silent[ids]))
            return "".join(b"".join(run).decode("utf-8", "replace_each_byte") for run in runs)


def _replace_each_byte(error):
    return "�" * (error.end - error.start), error.end


def _shared(df: DataFrame, model: bytes):
    """The model file as a broadcast (its size is bounded); a model that cannot
    be used is refused here, on the driver."""
    PieceModel(model)
    return df.sparkSession.sparkContext.broadcast({"model": model})


def _kept(held: dict, name: str, kind):
    """``kind`` built from the broadcast model; a worker keeps it, with its
    caches, from task to task."""
    if "tables" not in held:
        held["tables"] = PieceModel(held["model"])
    if name not in held:
        held[name] = kind(held["tables"])
    return held[name]


def encode(df: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col`` (array of int): the whole text's pieces, no begin or end ids."""
    shared = _shared(df, model)

    def make():
        encoder = _kept(shared.value, "encoder", Encoder)

        def compute(batch):
            coded = [encoder.encode(t) for t in texts_of(batch, text_col)]
            offsets = np.zeros(len(coded) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
            values = np.frombuffer(b"".join(coded), dtype=np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

        return compute

    return add_columns(df, f"`{ids_col}` array<int>", make)


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``: the text that the ids stand for (null ids: empty)."""
    shared = _shared(df, model)

    def make():
        codecs.register_error("replace_each_byte", _replace_each_byte)
        decoder = _kept(shared.value, "decoder", Decoder)

        def compute(batch):
            column = batch.column(ids_col)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            return [
                pa.array(
                    [
                        decoder.decode(values[a:b]) if ok else ""
                        for a, b, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)
                    ],
                    type=pa.string(),
                )
            ]

        return compute

    return add_columns(df, f"`{text_col}` string", make)


def codec_digest(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what :func:`encode`
    and :func:`decode` give, in one pass, so neither ids nor texts leave the worker."""
    shared = _shared(docs, model)

    def make():
        codecs.register_error("replace_each_byte", _replace_each_byte)
        encoder, decoder = _kept(shared.value, "encoder", Encoder), _kept(shared.value, "decoder", Decoder)
        numerals = _kept(shared.value, "numerals", lambda m: [str(i) for i in range(len(m.pieces))])

        def compute(batch):
            rows = []
            for text in texts_of(batch, "text"):
                ids = np.frombuffer(encoder.encode(text), dtype=np.int32)
                joined = ",".join([numerals[i] for i in ids.tolist()])
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in (joined, decoder.decode(ids))]
                rows.append((len(ids), *digests))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)]

        return compute

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return add_columns(docs.select("doc_id", "text"), fields, make).drop("text")

"""Exact encoding with a merge-type SentencePiece model by backtracking, and decoding.

Merging pairs from the best score down gives one sequence of pieces, and a
sequence is that one exactly when every two neighbours, merged afresh, stay as
they are. So the encoder takes the longest piece at each position (found by
Aho-Corasick for all positions at once), keeps it if it is compatible with the
piece before, falls back to its next shorter prefix otherwise, and steps back
where no prefix fits. A bitfield remembers positions that have failed, so each
piece is tried at most once at each position and the work stays linear.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, ship

SPACE = "▁"
REPLACEMENT = "�".encode()
#: Bounds of what one Python worker remembers; they change its speed only.
CACHED_CHUNKS, CACHED_PAIRS = 400_000, 2_000_000


class PieceCodec:
    """A model's pieces with ``encode`` and ``decode``; characters outside the pieces become byte pieces."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        kind = proto.ModelProto.SentencePiece
        spec = model.normalizer_spec
        plain = spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        own = [p.piece for p in model.pieces if p.type in (kind.USER_DEFINED, kind.UNUSED)]
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback or not plain or own:
            raise ValueError("only merge-type models with byte fallback, a dummy prefix and no text normalisation")
        self.end_id = model.trainer_spec.eos_id
        self.bytes_of: list[bytes] = []
        self.control: set[int] = set()
        self.byte_ids: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i, p in enumerate(model.pieces):
            surface = p.piece.replace(SPACE, " ").encode()
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                surface = bytes([int(p.piece[3:5], 16)])
            elif p.type == kind.CONTROL:
                surface = b""
            elif p.type == kind.UNKNOWN:
                surface = model.trainer_spec.unk_surface.encode()
            else:
                self.id_of[p.piece], self.score[p.piece] = i, p.score
            self.bytes_of.append(surface)
        self.byte_range = set(self.byte_ids.values())
        self.no_lead = self.byte_range | {model.trainer_spec.unk_id}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.chunks: tuple[dict, dict] = ({}, {})  # parts without and with a space before them
        # a piece that merging never forms is never in an encoding
        valid = [p for p in self.id_of if len(p) == 1 or self._merged(list(p)) == [p]]
        self.shorter: dict[str, str] = {}  # next shorter piece that is a prefix; a single character always is one
        known = set(valid)
        for p in valid:
            if len(p) > 1:
                self.shorter[p] = next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in known), p[0])
        self.matcher = ahocorasick.Automaton()
        for p in valid:
            self.matcher.add_word(p, p)
        self.matcher.make_automaton()
        # where pieces can never span, a text is cut first, so that parts seen before need no work
        self.cut_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in known)
        self.cut_at_line = not any("\n" in p and len(p) > 1 for p in known)
        ids = self._ids("\n")
        self.line_end = (ids, " ".join(map(str, ids)))

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merge the pair with the best score, the leftmost of equals, until none is left."""
        score = self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _fit(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self.compatible.get(pair)
        if found is None:
            if len(self.compatible) >= CACHED_PAIRS:
                self.compatible.clear()
            found = self.compatible[pair] = self._merged(list(left + right)) == [left, right]
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of an escaped text (spaces written as U+2581)."""
        longest: list[str] = list(text)
        for end, piece in self.matcher.iter(text):
            longest[end + 1 - len(piece)] = piece  # matches come by their end, so the longest is the last
        size, at, out, fit, shorter = len(text), 0, [], self._fit, self.shorter
        alive = bytearray(b"\x01") * (size + 1)
        piece = longest[0] if size else ""
        while at < size:
            end = at + len(piece)
            if alive[end] and (not out or fit(out[-1], piece)):
                out.append(piece)
                at = end
                piece = longest[at] if at < size else ""
            elif len(piece) > 1:
                piece = shorter[piece]
            else:
                alive[at] = 0
                piece = out.pop()
                at -= len(piece)
        return out

    def _ids(self, escaped: str) -> tuple[int, ...]:
        ids, of = [], self.id_of
        for piece in self.pieces(escaped):
            one = of.get(piece)
            if one is None:
                ids.extend(self.byte_ids[b] for b in piece.encode())
            else:
                ids.append(one)
        return tuple(ids)

    def _chunk(self, piece: str, spaced: bool = True) -> tuple[tuple[int, ...], str]:
        """Ids of a part of a text, which a space precedes or not, and their decimal form."""
        found = self.chunks[spaced].get(piece)
        if found is None:
            ids = self._ids((SPACE if spaced else "") + piece.replace(" ", SPACE))
            if len(self.chunks[spaced]) >= CACHED_CHUNKS:
                self.chunks[spaced].clear()
            found = self.chunks[spaced][piece] = (ids, " ".join(map(str, ids)))
        return found

    _CUT = re.compile(f"(?<=[^ {SPACE}]) ")

    def chunk_ids(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """Per part of the text its ids and their decimal form; no parts for an empty text."""
        if not text:
            return []
        if not self.cut_at_space or not self.cut_at_line:
            return [self._chunk(text)]
        out, known, one = [], self.chunks[True].get, self._chunk
        for n, line in enumerate(text.split("\n")):
            head, *rest = self._CUT.split(line)
            if n:
                out.append(self.line_end)
            if head or not n:
                out.append(one(head, not n))
            out += [known(p) or one(p) for p in rest]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text, with the end id."""
        return [*chain.from_iterable(ids for ids, _ in self.chunk_ids(text)), self.end_id]

    def decode(self, ids: list[int]) -> bytes:
        """The text of ids in UTF-8; a byte that is part of no character becomes U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        first = next((i for i in ids if self.bytes_of[i]), None)
        lead = first is not None and first not in self.no_lead and raw[:1] == b" "
        raw = raw[1:] if lead else raw
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return self._decode_checked(ids, lead)

    def _decode_checked(self, ids: list[int], lead: bool) -> bytes:
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + n]).decode().encode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append(REPLACEMENT)
                    at += 1
            run.clear()

        for i in ids:
            if i in self.byte_range:
                run += self.bytes_of[i]
            else:
                flush()
                out.append(self.bytes_of[i])
        flush()
        text = b"".join(out)
        return text[1:] if lead else text


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The model, read once per Python process."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``ids``: the ids of each text (null as empty), with the end id."""

    @F.pandas_udf("array<int>")
    def ids(texts):
        encode = codec(model_file).encode
        return texts.map(lambda t: encode(t or ""))

    ship(docs.sparkSession)
    return docs.withColumn("ids", ids(F.col(text_col)))


def decoded(docs: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids; null for null."""

    @F.pandas_udf("string")
    def text(arrays):
        decode = codec(model_file).decode
        return arrays.map(lambda a: None if a is None else decode(a).decode())

    ship(docs.sparkSession)
    return docs.withColumn(out_col, text(F.col(ids_col)))


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, for every row.

    A null text counts as empty, which has the end id alone and decodes to the
    empty text; repeated rows each give a row; other columns are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(model_file)
        end, sha = str(model.end_id), hashlib.sha256
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                chunks = model.chunk_ids(text.as_py() or "")
                ids = [*chain.from_iterable([ids for ids, _ in chunks]), model.end_id]
                n.append(len(ids))
                ids_sha.append(sha(" ".join([*(s for _, s in chunks), end]).encode()).hexdigest())
                text_sha.append(sha(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, run, "doc_id long, " + DIGEST)

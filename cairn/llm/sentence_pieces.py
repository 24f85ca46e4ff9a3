"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

The automaton runs over the text once. At each position its output links give every piece that
ends there, and the best chain to that position is relaxed with each of them:

* in a *unigram* model a chain's worth is the sum of its pieces' scores, the highest wins;
* in a *byte-pair* model scores only order the merges, and the highest sum is not what the
  library gives. There a piece may follow only where it is *stable* behind the last piece of the
  best chain (merging the characters of both in the order of the scores gives just these two);
  exactly one piece is, and the chain is the library's result. User-defined pieces, which such
  models cut out first, are refused.

Characters no piece holds become byte pieces, or the unknown piece. No piece crosses the border
before a blank, so words are encoded apart and a bounded number of them is remembered.

Defined results: null and empty texts give no ids; texts of any length are taken whole; repeated
rows give repeated results; an empty table an empty one. Decoding gives the text back, but for
U+2581 in a text, which the format itself writes for a blank. Only ``doc_id`` and ``text`` are
read, so further columns can't clash.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from cairn.llm.common import Remembered, map_rows, texts

#: Words whose ids a worker remembers at most, and half of it in pairs of pieces.
REMEMBERED = 400_000
#: Fixed values of the format: the sign for a blank, kinds of pieces and models, the penalty of
#: unknown characters.
BLANK = "▁"
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNIGRAM, BYTE_PAIRS = 1, 2
UNKNOWN_PENALTY = 10.0
#: Stands for a text's begin or an unknown character in chains.
NONE = (1 << 20) - 1


class Pieces:
    """A SentencePiece model's pieces, with the automaton over them."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.byte_pairs = proto.trainer_spec.model_type == BYTE_PAIRS
        if not self.byte_pairs and proto.trainer_spec.model_type != UNIGRAM:
            raise ValueError("only unigram and byte-pair models have scored pieces")
        spec = proto.normalizer_spec
        self.dummy_prefix = spec.add_dummy_prefix
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.piece = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        whole = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
        if self.byte_pairs and any(p.type == USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces of a byte-pair model are not known here")
        self.worth = {p: self.scores[i] for p, i in whole.items()}
        self.characters = {p for p in whole if len(p) == 1}
        self.unknown_score = min((self.scores[i] for i in whole.values()), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, number in whole.items():
            self.automaton.add_word(piece, (number, len(piece)))
        if whole:
            self.automaton.make_automaton()
        self.out = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else p.piece.replace(BLANK, " ").encode() if p.type in (NORMAL, USER_DEFINED)
            else b" \xe2\x81\x87 " if p.type == UNKNOWN else b""
            for p in proto.pieces
        ]
        crossing = any(BLANK in p.lstrip(BLANK) for p in whole)
        breaks = "" if any("\n" in p for p in whole) else "\n"
        self.units = re.compile(
            r"(?s).+" if crossing
            else f"\n|{BLANK}*[^{BLANK}{breaks}]+|{BLANK}+" if breaks else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.pairs: dict[int, bool] = {}
        self.unit_ids = Remembered(self._unit, REMEMBERED)

    def merged(self, text: str) -> list[str]:
        """The characters of a short text, neighbours merged while they make a piece: the highest score
        first, the leftmost of equal ones."""
        parts, worth = list(text), self.worth
        while True:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                score = worth.get(parts[i] + parts[i + 1], -np.inf)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _stable(self, left: int, right: int, key: int) -> bool:
        if len(self.pairs) >= 4 * REMEMBERED:
            self.pairs.clear()
        pair = [self.piece[i] for i in (left, right) if i != NONE]
        known = self.pairs[key] = self.merged("".join(pair)) == pair
        return known

    def _chain(self, unit: str) -> list[tuple[int, int]]:
        """For each position, the last piece of the best chain to it, and where that piece starts."""
        characters, pairs, scores = self.characters, self.pairs, self.scores
        last, starts = [NONE] * (len(unit) + 1), [-1] * (len(unit) + 1)
        if self.byte_pairs:
            for end, (piece, size) in self.automaton.iter(unit):
                end += 1
                start = end - size
                if starts[end] < 0 and (start == 0 or starts[start] >= 0 or unit[start - 1] not in characters):
                    key = last[start] << 20 | piece
                    known = pairs.get(key)
                    if known or known is None and self._stable(last[start], piece, key):
                        last[end], starts[end] = piece, start
        else:
            best, done, step = [0.0] + [-np.inf] * len(unit), 0, self.unknown_score
            for end, (piece, size) in self.automaton.iter(unit):
                end += 1
                while done < end - 1:  # positions where no piece ends
                    done += 1
                    if unit[done - 1] not in characters and best[done - 1] + step > best[done]:
                        best[done] = best[done - 1] + step
                        last[done], starts[done] = NONE, done - 1
                worth = best[end - size] + scores[piece]
                if worth > best[end]:
                    best[end], last[end], starts[end] = worth, piece, end - size
        return list(zip(last, starts))

    def _unit(self, unit: str) -> bytes:
        chain, ids, end = self._chain(unit), [], len(unit)
        while end > 0:
            piece, start = chain[end]
            if piece == NONE:
                start = end - 1
                letter = unit[start].encode()
                ids += [self.bytes[b] for b in reversed(letter)] if self.bytes else [self.unknown]
            else:
                ids.append(piece)
            end = start
        ids.reverse()
        if not self.bytes:  # neighbouring unknown characters are one unknown piece
            ids = [x for i, x in enumerate(ids) if x != self.unknown or i == 0 or ids[i - 1] != x]
        return np.array(ids, dtype="<i4").tobytes()

    def normal(self, text: str) -> str:
        if not self.plain:
            return self.library.normalize(text)
        return (BLANK if self.dummy_prefix and text else "") + text.replace(" ", BLANK)

    def encode(self, text: str) -> np.ndarray:
        unit, get = self.unit_ids, self.unit_ids.new.get
        parts = [get(u) or unit(u) for u in self.units.findall(self.normal(text))]
        return np.frombuffer(b"".join(parts), dtype="<i4")

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


@functools.cache
def pieces(path: str) -> Pieces:
    with open(path, "rb") as file:
        return Pieces(file.read())


def encode(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids`` and whether decoding them gives the text back (``round_trip``)."""

    def run(rows: dict) -> dict:
        coder = pieces(model)
        made = [coder.encode(t) for t in rows["text"]]
        back = [coder.decode(ids.tolist()) == t for ids, t in zip(made, rows["text"])]
        return {"doc_id": rows["doc_id"], "ids": made, "round_trip": back}

    return map_rows(texts(documents), "doc_id bigint, ids array<int>, round_trip boolean", run)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``ids``; null ids give an empty text."""

    def run(rows: dict) -> dict:
        coder = pieces(model)
        return {"doc_id": rows["doc_id"], "text": [coder.decode(ids or []) for ids in rows["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), "doc_id bigint, text string", run)

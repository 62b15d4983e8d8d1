"""Exact token ids and counts of a byte-level BPE, by looking up space-led pieces of text.

A space after a non-blank always starts a new pre-token of this kind of tokenizer, so a text may be cut there
and its pieces be encoded on their own. Pieces repeat, whole texts do not: each distinct piece is
encoded once for each worker and looked up from then on.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array

VOCABULARY = "byte_bpe_50k.json"
#: Pieces of these characters may be encoded by the rank file of the same vocabulary, several times quicker and to
#: the same ids (a test compares them); all others go to the tokenizer itself.
_PLAIN = re.compile(r"[\n -~\u00c0-\u024f]+").fullmatch
#: Only shorter pieces are kept, at most so many: bounds a worker's memory.
KEPT_PIECE, KEPT_PIECES = 64, 500_000
#: A space that follows a blank may belong to the run of blanks before it, so it is no place to cut.
_AFTER_BLANK = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """The text between the spaces at which it may be cut; all but the first follow one space."""
    return _CUT.split(text) if _AFTER_BLANK.search(text) or text[:1] == " " else text.split(" ")


class PieceEncoder(dict):
    """Piece after a space -> `value` of its ids. A miss is encoded and, while there is room, kept."""

    def __init__(self, path: str, value, known: dict | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__(known or {})
        self.tokenizer, self.ranks, self.value = Tokenizer.from_file(path), _ranks(path), value

    def __missing__(self, piece: str):
        found = self.encode(f" {piece}")
        if len(piece) <= KEPT_PIECE and len(self) < KEPT_PIECES:
            self[piece] = found
        return found

    def encode(self, text: str):
        if self.ranks and "<|" not in text and _PLAIN(text):
            return self.value(self.ranks.encode_ordinary(text))
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_text(self, text: str) -> list:
        """The values of its pieces, in order."""
        first, *rest = pieces(text)
        return [self.encode(first), *map(self.__getitem__, rest)]


_OF_WORKER: dict[tuple, PieceEncoder] = {}


def worker_encoder(path: str, value, known=dict) -> PieceEncoder:
    """The encoder that all tasks of this worker process share; `known()` gives what it starts from."""
    key = (path, value)
    if key not in _OF_WORKER:
        _OF_WORKER[key] = PieceEncoder(path, value, known())
    return _OF_WORKER[key]


def _ranks(path: str):
    """The rank file beside a vocabulary, where there is one."""
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    return encoding._core_bpe


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()

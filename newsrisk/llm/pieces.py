"""A SentencePiece vocabulary as plain tables, and the cut of a text into independent pre-tokens."""

from __future__ import annotations

import re
from dataclasses import dataclass

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: An unknown character costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    """Pieces with a plain space for the space mark, their ids and scores; ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    unknown: float
    longest: int
    cut: str  # pattern of a pre-token

    @property
    def text_of(self) -> dict[int, str]:
        return {i: p for p, i in self.ids.items()}


def load(model_file: str = MODEL_FILE) -> Vocabulary:
    """Read the model on the driver; its tables (half a megabyte) travel with the tasks.

    Pre-tokens are cut where no piece can lie across: before a run of spaces, if no piece has a
    space after another character, and around line ends, if no piece holds one. The best path of
    a text is then the best paths of its pre-tokens, one after the other. Without these
    conditions the whole text is one pre-token.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids, scores, byte_ids = {}, {}, [-1] * 256
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            p = p.replace("▁", " ")
            ids[p], scores[p] = i, float(sp.get_score(i))
    if min(byte_ids) < 0:
        raise ValueError(f"{model_file} has no byte pieces: unknown characters could not be encoded")
    plain = not any(re.search("[^ ] ", p) for p in ids) and not any("\n" in p for p in ids)
    return Vocabulary(ids, scores, byte_ids, min(scores.values()) - UNKNOWN_PENALTY, max(map(len, ids)), r" *[^ \n]+| +|\n" if plain else r"(?s).+")

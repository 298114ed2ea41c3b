"""The piece table of a public SentencePiece model. The model is read, never trained."""

from __future__ import annotations

from dataclasses import dataclass

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # how pieces write a space


@dataclass(frozen=True)
class Piece:
    id: int
    text: str
    score: float


@dataclass(frozen=True)
class PieceTable:
    pieces: tuple[Piece, ...]      # ordinary pieces, without control and byte pieces
    byte_ids: tuple[int, ...]      # id of the piece of each byte value


def load_pieces(path: str = MODEL_PATH) -> PieceTable:
    """Read on the driver once; the table is a fixed vocabulary of some hundred kilobytes, so
    shipping it to every task is bounded whatever the input."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary, by_byte = [], {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            by_byte[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ordinary.append(Piece(i, model.id_to_piece(i), model.get_score(i)))
    if len(by_byte) != 256:
        raise ValueError("the model has no byte fallback")
    return PieceTable(tuple(ordinary), tuple(by_byte[b] for b in range(256)))

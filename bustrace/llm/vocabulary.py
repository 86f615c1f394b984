"""Encoders for the vocabulary files of public tokenizers. A worker loads each file once."""

from __future__ import annotations

import base64
from functools import cache

END_OF_TEXT = "<|endoftext|>"


@cache
def ranks_encoder(path: str, pattern: str, specials: tuple[tuple[str, int], ...]):
    """text -> numpy array of ids, from a file of byte-pair ranks. Special strings inside a text become their ids."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(specials))
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


@cache
def pieces_encoder(path: str):
    """The sentencepiece processor of a model file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)

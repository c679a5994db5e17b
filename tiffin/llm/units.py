"""Short cuts into byte-level tokenizers for words that need no normalising and no splitting."""

from __future__ import annotations

import re

from tiffin.llm.token_counts import byte_letters

# Latin letters, each a single code point that composing leaves alone.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_letters = re.compile(f"[{LATIN}]+").fullmatch
_bytes = byte_letters()
_spelled = {
    i: "".join(_bytes[b] for b in chr(i).encode()) for i in (0x20, *range(0xC0, 0x250))
}


def model_ids(model, words: list[str]) -> list[list[int] | None]:
    """The ids of words that are one pre-token of Latin letters, perhaps after one blank; None
    for all others. `model` is that of the tokenizer library: the steps before it have nothing
    to do on such words but to write bytes as letters."""
    tokenize = model.tokenize
    return [
        [t.id for t in tokenize(w if w.isascii() and w[0] != " " else w.translate(_spelled))]
        if _letters(w, 1 if w[:1] == " " else 0) else None
        for w in words
    ]

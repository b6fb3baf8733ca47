"""Token ids of a public byte-level BPE vocabulary, on the executors."""

from __future__ import annotations

import json
import re

import numpy as np

#: Fixed value: how this vocabulary splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of other characters go to the reference tokenizer, so that Unicode tables can't differ.
_UNUSUAL = re.compile("[^\\x20-\\x7e\\n\\t\\rÀ-ɏ]")
_loaded: dict[str, "TokenIds"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes_of_symbols() -> dict[str, int]:
    """The printable symbol by which byte-level vocabularies write each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenIds:
    """Encodes texts as the tokenizer file does; texts with a string of a special token go to the reference tokenizer."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        self.special = [t["content"] for t in file.get("added_tokens") or []]
        symbol = _bytes_of_symbols()
        ranks = {bytes(symbol[c] for c in t): i for t, i in vocabulary.items() if all(c in symbol for c in t) and not t.startswith("<|")}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if _UNUSUAL.search(text) or any(t in text for t in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text).astype(np.uint32, copy=False)


def tokenizer(path: str) -> TokenIds:
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = TokenIds(path)
    return _loaded[path]

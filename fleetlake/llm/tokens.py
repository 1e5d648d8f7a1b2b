"""Exact byte-level BPE: the ids of the ``tokenizers`` library, at the speed of ``tiktoken`` where
the two provably agree.

``tokenizers`` is the yardstick. Texts of ordinary Latin, Greek and Cyrillic characters go through
``tiktoken`` with ranks read from the same vocabulary file; texts with any other character, or with
very long runs (where its pattern engine backtracks), are encoded by ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k.json"

# Letters, digits, marks and white space on which all Unicode versions agree.
_OTHER = re.compile("[^\t\n\r\x20-\x7e¡-ɏΑ-ΡΣ-ώА-я‐-‧‰-⁞]")
_LONG = re.compile(r"\s{400}|\S{2000}")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the others are counted up from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return out


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = _byte_alphabet()
        size = max([*vocabulary.values(), *added.values()]) + 1
        names = [b""] * size
        for token, i in vocabulary.items():
            names[i] = token.encode() if token in added else bytes(alphabet[c] for c in token)
        for token, i in added.items():
            names[i] = token.encode()
        self.bytes = np.empty(size, dtype=object)
        self.bytes[:] = names
        self.lengths = np.array([len(x) for x in names], dtype=np.int64)
        self.decimal = np.empty(size, dtype=object)
        self.decimal[:] = [b"%d" % i for i in range(size)]
        self.fast = self._fast(spec, vocabulary, merges, added, names)

    @staticmethod
    def _fast(spec, vocabulary, merges, added, names):
        """A tiktoken encoder, if ids are merge ranks and the splitting rule is the usual one."""
        ids = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in merges]
        pre = spec["pre_tokenizer"] or {}
        plain = all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if (ids != list(range(256, 256 + len(ids))) or spec["normalizer"] or spec["model"].get("ignore_merges") or not plain
                or (pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space")) != ("ByteLevel", True, False)):
            return None
        try:
            import public_tokenizers
            import tiktoken

            ranks = {names[i]: i for t, i in vocabulary.items() if t not in added}
            return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens=added)
        except ImportError:
            return None

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or (not text.isascii() or not text.isprintable()) and _OTHER.search(text) or _LONG.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes[ids].tolist())

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path)

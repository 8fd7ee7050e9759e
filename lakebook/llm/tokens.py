"""Token ids and bytes of byte-level BPE vocabularies, for whole texts.

The vocabulary file is that of a public tokenizer, named by its path. Where its merges are
in the order of their ids, the ids are those of a merge by lowest rank, and a compiled
encoder without offsets gives them at a fraction of the time; otherwise, and for texts
that its pattern can't take, the tokenizer's own library encodes. Nothing is remembered
between texts, so memory does not grow with the corpus.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np

# Fixed value: how this family of tokenizers cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space beyond this is cut by the tokenizer's own library.
LONG_SPACE = re.compile(r"\s{5000}")


def byte_letters() -> dict[str, int]:
    """How a byte-level vocabulary spells bytes: printable ones as themselves, the others
    by the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBPE:
    """Ids of texts; with ``special`` the strings of special tokens are these tokens."""

    def __init__(self, path: str, special: bool):
        self.path, self.special = path, special
        data = json.loads(Path(path).read_text(encoding="utf-8"))
        letters, vocab = byte_letters(), data["model"]["vocab"]
        added = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        self.bytes_of = {
            i: bytes(map(letters.__getitem__, spelled)) for spelled, i in vocab.items() if spelled not in added
        }
        self.special_ids = added
        self.fast = self._fast(data, vocab) if self._by_rank(data, vocab) else None

    @staticmethod
    def _by_rank(data: dict, vocab: dict[str, int]) -> bool:
        cut, model = data.get("pre_tokenizer") or {}, data["model"]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ids = [vocab["".join(pair)] for pair in pairs]
        usual = not (data.get("normalizer") or model.get("dropout") or model.get("ignore_merges"))
        bare = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in data.get("added_tokens", ()))
        return bool(plain and usual and bare and ids == sorted(ids))

    def _fast(self, data: dict, vocab: dict[str, int]):
        import tiktoken

        ranks = {spelled: i for i, spelled in self.bytes_of.items()}
        return tiktoken.Encoding(self.path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special_ids)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.path)
        whole.encode_special_tokens = not self.special
        return whole

    def ids(self, text: str) -> np.ndarray:
        """The ids as unsigned 32-bit numbers."""
        if self.fast is not None and not LONG_SPACE.search(text):
            return self.fast.encode_to_numpy(
                text, allowed_special="all" if self.special else set(), disallowed_special=()
            )
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    @cached_property
    def spelled(self) -> list[bytes]:
        """The bytes of every id; of special tokens, their string."""
        table = [b""] * (max([*self.bytes_of, *self.special_ids.values()], default=-1) + 1)
        for i, raw in self.bytes_of.items():
            table[i] = raw
        for content, i in self.special_ids.items():
            table[i] = content.encode("utf-8")
        return table


@lru_cache(maxsize=4)
def byte_bpe(path: str, special: bool = True) -> ByteBPE:
    """One encoder a worker and vocabulary; its size is that of the vocabulary."""
    return ByteBPE(path, special)

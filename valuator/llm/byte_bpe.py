"""Byte-level BPE ids as a tokenizer file gives them, at the speed of a pattern without look-ahead.

The splitting pattern of these files looks ahead only to leave the last
character of a run of white space to the next word. In a text without two
white-space characters in a row it is the same as a plain pattern, which takes
half the time. Other texts take the full pattern, and a text that holds the
name of a special token goes through the tokenizer itself.
"""

from __future__ import annotations

import functools
import re
from array import array

# Fixed value: the pattern of this kind of tokenizer file (ByteLevel).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without white-space runs.
NO_RUNS = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_RUN = re.compile(r"\s\s")


class ByteBPE:
    """Ids of texts as ``tokenizers`` gives them without added special tokens."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        byte_of = {c: b for b, c in _byte_names().items()}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in self.whole.get_vocab(with_added_tokens=False).items() if token not in self.special}
        self.full = tiktoken.Encoding("full", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = tiktoken.Encoding("plain", pat_str=NO_RUNS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> array:
        if any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids)
        return array("I", (self.full if _RUN.search(text) else self.plain).encode_ordinary(text))


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary (a rule of that file format)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.cache
def load(path: str) -> ByteBPE:
    return ByteBPE(path)

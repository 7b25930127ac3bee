"""Cutting texts where byte-level BPE never merges across.

The tokenizers' split pattern takes at most one leading space into a piece, and a run of
white space gives its last space to the word that follows. So a space with a character
other than white space behind it always starts a new piece, and the tokens of a text are
the tokens of the chunks between such places. A line break between two such characters
is a piece of its own. Words repeat, so each is encoded once and looked up afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from opinara.llm.common import Memory

_BREAK = re.compile(r"(?= \S)")
_MARKS = frozenset("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
#: Bytes of chunks that a worker remembers before it begins anew; only speed depends on it.
MEMORY = 64 << 20
#: Chunks that are encoded at once.
LEARNT = 8192


def chunks(text: str) -> list[str]:
    """Keys of the text's chunks, in order.

    A word alone stands for itself with its blank before it, a word behind a line break
    for both, and anything behind a tab for itself. Where all white space is single blanks
    and line breaks between words, the words are the chunks; else only blanks cut.
    """
    words = text.split()
    if " ".join(words) != text.replace("\n", " "):
        return ["\t" + c for c in _BREAK.split(text) if c]
    if not words:
        return words
    if "\n" not in text:
        words[0] = "\t" + words[0]
        return words
    out = []
    for k, line in enumerate(text.split("\n")):
        own = line.split(" ")
        own[0] = ("\n" if k else "\t") + own[0]
        out += own
    return out


def pieces(key: str) -> list[str]:
    """The keys of a chunk's parts: a line break apart, an ASCII mark behind letters apart."""
    out = ["\t\n", "\t" + key[1:]] if key[0] == "\n" else [key]
    last = out[-1]
    letters = last[1:-1] if last[0] == "\t" else last[:-1]
    if last[-1] in _MARKS and letters and (letters[1:] if letters[0] == " " else letters).isalpha():
        out[-1:] = [last[:-1], "\t" + last[-1]]
    return out


def text_of(key: str) -> str:
    """The text of a part."""
    return key[1:] if key[0] == "\t" else " " + key


class ChunkCoder:
    """Packed token ids of texts through a memory of chunks and their parts.

    ``encode`` gets the texts of the distinct parts not yet known and returns their
    packed ids. ``memory`` is in bytes.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], memory: int = MEMORY):
        self.encode = encode
        self.memory = Memory(memory)

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """Packed ids of chunks, and of their parts."""
        cut = list(map(pieces, new))
        found = {p: self.memory.get(p) for ps in cut for p in ps}
        missing = [p for p, ids in found.items() if ids is None]
        for at in range(0, len(missing), LEARNT):
            own = missing[at : at + LEARNT]
            found.update(zip(own, self.encode(list(map(text_of, own))), strict=True))
        whole = {c: b"".join([found[p] for p in ps]) for c, ps in zip(new, cut) if len(ps) > 1}
        return {p: found[p] for p in missing} | whole

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [chunks(t) for t in texts]
        distinct = set().union(*cut)
        known = self.memory.recall(distinct, self.learn)
        # The batch's own words fit the processor's cache, all known ones do not.
        get = {c: known[c] for c in distinct}.__getitem__
        return [b"".join(map(get, cs)) for cs in cut]

"""Splitting long texts for byte-level BPE with a memo above the pre-token pattern."""

from __future__ import annotations

from collections.abc import Callable

#: Entries of one memo before it starts anew.
MEMO_ENTRIES = 700_000
#: Longer strings are encoded without a memo entry.
MEMO_CHARS = 48


class Memo(dict):
    """string -> packed ids, filled by ``make`` on demand; bounded."""

    def __init__(self, make: Callable[[str], bytes | None], entries: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key: str) -> bytes | None:
        ids = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.clear()
            self[key] = ids
        return ids


#: Signs that form one pre-token at the end of a chunk, and the last character for which isalpha() and \\p{L} agree in all Unicode versions.
_SIGNS, _LAST = ".,;:!?%$&#*)\"", "\u024f"


class _Chunks(Memo):
    """Memo of the chunks after ``lead`` (a space, or nothing at a line's begin); None for one that can't stand alone."""

    def __init__(self, owner: ChunkEncoder, lead: str, entries: int):
        super().__init__(owner.encode_pretoken, entries)
        self.owner, self.lead = owner, lead

    def __missing__(self, part: str) -> bytes | None:
        core = part.rstrip(_SIGNS)
        if core.isalpha() and (core.isascii() or max(core) <= _LAST):
            ids = self.make(self.lead + part) if len(core) == len(part) else self[core] + self.owner.pretokens[part[len(core) :]]
        else:
            ids = self.other(part)
        if len(part) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.clear()
            self[part] = ids
        return ids

    def other(self, part: str) -> bytes | None:
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        head, line, tail = part.partition("\n")
        if line and not head[-1].isspace() and not tail[0].isspace():
            return self[head] + self.owner.pretokens[line] + self.owner.first[tail]
        return self.owner.whole(self.lead + part)


class ChunkEncoder:
    """Encodes whole texts by memoised chunks between single spaces.

    A single space between two characters that aren't white space always begins a pre-token
    of the patterns used here (`` ?`` before letters, digits or other signs), so the chunks
    " word," of a text can be split and encoded on their own, and most of them are in the memo.
    A chunk of letters is one pre-token, signs after it are the next, and a line break inside a
    chunk is one between two; other chunks go through the pattern, and so does a whole text
    with other white space next to a space."""

    def __init__(self, split: Callable[[str], list[str]], encode_pretoken: Callable[[str], bytes]):
        self.split, self.encode_pretoken = split, encode_pretoken
        self.pretokens = Memo(encode_pretoken, 100_000)
        self.inner = _Chunks(self, " ", MEMO_ENTRIES)
        self.first = _Chunks(self, "", 100_000)

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.pretokens.__getitem__, self.split(text)))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        packed = list(map(self.inner.__getitem__, parts))
        packed[0] = self.first[parts[0]]
        try:
            return b"".join(packed)
        except TypeError:
            return self.whole(text)

"""Token ids of whole texts by the tokenizers library, with a memo of words.

A byte-level BPE with the usual splitting rule never merges across a single space between two other characters, so a
text is the first unit followed by units that each begin with that space. Units repeat far more often than texts do; a
unit that a worker meets a second time is kept, as long as the memo has room, and doesn't go through the library again. Texts for which the rule
doesn't hold (other white space beside a space, a leading or trailing space, the text of a special token) go through
the library as a whole.
"""

import os
import struct

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the unit of parallel work

from tokenizers import Tokenizer  # noqa: E402

from opinera.llm.memos import claim  # noqa: E402

#: Units kept by a worker. Beyond that, units are encoded each time: slower, same ids.
MEMO_UNITS = 700_000
#: Longer units are not kept, so that the memo's memory is bounded too.
MEMO_CHARS = 40

#: Units told apart among those met once; if two share a bit, one is kept too early.
SEEN_BITS = 1 << 24

_encoders: dict[str, "UnitEncoder"] = {}


def encoder(path: str, most: int = MEMO_UNITS) -> "UnitEncoder":
    """One per worker and file. Its memo goes when the worker turns to another operator's work, the tokenizer stays."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    _encoders[path].most = most
    claim(f"tokens {path}", _encoders[path].memo.clear)
    return _encoders[path]


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class UnitEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.most = MEMO_UNITS
        self.met = bytearray(SEEN_BITS >> 3)  # a bit a unit, by hash: most units come once, and those aren't kept
        self.id_bytes = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.letters = str.maketrans({chr(i): c for i, c in enumerate(_byte_letters())})
        self.model = self.tokenizer.model

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        """Of one piece that the splitting rule leaves whole."""
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        table = self.id_bytes
        return b"".join([table[t.id] for t in self.model.tokenize(mapped)])

    def _unit(self, unit: str) -> bytes | None:
        """Of a space and unit; None if the unit can't stand alone."""
        if not unit or unit[0].isspace() or unit[-1].isspace():
            return None
        if unit.isalpha():
            found = self._piece(f" {unit}")
        elif unit[-1] in ".,;:!?" and unit[:-1].isalpha():
            found = self._piece(f" {unit[:-1]}") + self._piece(unit[-1])
        else:
            found = self.whole(f" {unit}")
        if len(self.memo) < self.most and len(unit) <= MEMO_CHARS:
            bit = hash(unit) & SEEN_BITS - 1
            if self.met[bit >> 3] >> (bit & 7) & 1:
                self.memo[unit] = found
            else:
                self.met[bit >> 3] |= 1 << (bit & 7)
        return found

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; none for null."""
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self.whole(text)
        first, *units = text.split(" ")
        if not units or not first or first[-1].isspace():
            return self.whole(text)
        parts = list(map(self.memo.get, units))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    part = self.memo.get(units[i]) or self._unit(units[i])
                    if part is None:
                        return self.whole(text)
                    parts[i] = part
        return self.whole(first) + b"".join(parts)

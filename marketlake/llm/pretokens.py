"""Cuts texts into pieces that the word tokenizer encodes independently of one another, and pieces into its words.

A piece is a run of anything but ASCII white space. White space takes part in no composition, no word and no special token
of the tokenizer file, so the ids of a text are those of its pieces one after another. What happens inside a piece is
left to the tokenizers library: its normalizer, its pre-tokenizer, its tables of characters. Texts of characters below
PLAIN alone are cut into words at once: what each of those characters is (letter, number, white space, other) and what it
becomes is asked of the library when a task starts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import chain

#: Words and pieces whose ids a task remembers; beyond it the memory starts anew.
MEMORY = 600_000
#: Combining marks start here; characters below compose with nothing.
PLAIN = 0x300
# The rules of the tokenizer file under which white space parts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]


class Words:
    """The words of a piece in the byte alphabet, as the library's own normalizer and pre-tokenizer make them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = read_spec(path)
        tokenizer = Tokenizer.from_file(path)
        self.normalize, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # special tokens are found in the raw text, before anything else
        self.pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.alphabet = dict(enumerate(byte_alphabet()))
        kinds = {chr(c): self._kind(chr(c)) for c in range(PLAIN)}
        plain = [c for c, kind in kinds.items() if kind == "space" or self.normalize(f"x{c}x") == f"x{c.lower()}x" and c.lower() in kinds]
        of = lambda kind: "[" + "".join(re.escape(c) for c in kinds if kinds[c] == kind) + "]"
        self.plain = re.compile("[" + "".join(map(re.escape, plain)) + "]*")
        # The endings that the pattern of the tokenizer file names.
        self.word = re.compile(f"'(?:s|t|re|ve|m|ll|d)|{of('letter')}+|{of('number')}|{of('other')}+")

    def _kind(self, c: str) -> str:
        if len(self.cut(f"ab{c}ab")) < 3:
            return "letter" if self.cut(f"ab{c}ab")[0][0] != "ab" else "space"
        return "number" if len(self.cut(c + c)) == 2 else "other"

    def plain_words(self, text: str) -> list[str] | None:
        """The words of a text of plain characters without special tokens, in lower case; None for any other text."""
        if not self.plain.fullmatch(text) or self.pattern and self.pattern.search(text):
            return None
        return self.word.findall(text.lower())

    def in_bytes(self, word: str) -> str:
        """A word in the byte alphabet."""
        return word if word.isascii() and word.isprintable() else "".join(map(self.alphabet.__getitem__, word.encode()))

    def of(self, piece: str) -> list[tuple[bool, str]]:
        """(whether it is a special token, word) in order."""
        parts = self.pattern.split(piece) if self.pattern else [piece]
        out: list[tuple[bool, str]] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append((True, part))
            elif part:
                out.extend((False, word) for word, _ in self.cut(self.normalize(part)))
        return out


class Pieces:
    """Encodes whole texts by the ids of their words and pieces; one seen before is not encoded again.

    Ids are little-endian unsigned 32-bit integers.
    """

    def __init__(self, path: str, word_ids: Callable[[str], bytes], piece_ids: Callable[[list[str]], list[bytes]]):
        """word_ids: the ids of a word in the byte alphabet; piece_ids: those of each of some pieces."""
        self.words = Words(path)
        self.word_ids, self.piece_ids = word_ids, piece_ids
        self.seen: dict[str | bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text is an empty one."""
        lists: list[list] = []
        for t in texts:
            plain = self.words.plain_words(t) if t else []
            lists.append(t.encode().split() if plain is None else plain)
        fresh = set(chain.from_iterable(lists)).difference(self.seen)
        if len(self.seen) + len(fresh) > MEMORY:
            self.seen.clear()
            fresh = set(chain.from_iterable(lists))
        pieces = [x for x in fresh if isinstance(x, bytes)]
        for at in range(0, len(pieces), 10_000):
            part = pieces[at : at + 10_000]
            self.seen.update(zip(part, self.piece_ids([p.decode() for p in part]), strict=True))
        for w in fresh.difference(pieces):
            self.seen[w] = self.word_ids(self.words.in_bytes(w))
        return [b"".join(map(self.seen.__getitem__, x)) for x in lists]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else the next ones from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [hidden.get(b, chr(b)) for b in range(256)]


def read_spec(path: str) -> dict:
    """A tokenizer file; refuses one under whose rules white space might not part a text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = [x["type"] for x in spec["normalizer"]["normalizers"]]
    steps = spec["pre_tokenizer"]["pretokenizers"]
    if norm != NORMALIZERS or steps[0]["pattern"] != {"Regex": PATTERN} or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        raise ValueError("the tokenizer file splits texts by other rules")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
        raise ValueError("special tokens with such options are not supported")
    return spec

"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton gives the longest token at each place of a word that is reached. Tokens are taken from left to right; a token may
follow another only if the merges, applied to the two together, leave them apart (the pair-compatibility table). Where
none fits, the last token is replaced by its next shorter prefix. The path found is the one that the merges give.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import text_slices
from marketlake.llm.pretokens import Pieces, read_spec

#: Stands for the end of a word inside this module; it is no letter of the byte alphabet.
END = "\x00"
#: A time after all merges.
NEVER = 1 << 60


class Encoder(Pieces):
    def __init__(self, path: str):
        super().__init__(path, lambda word: np.array(self.word(word), "<u4").tobytes(), lambda pieces: list(map(self.piece, pieces)))
        model = read_spec(path)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        inner = {t: (t.removesuffix(suffix) + END if t.endswith(suffix) and t != suffix else t) for t in vocab}
        self.text = {i: inner[t] for t, i in vocab.items()}
        self.id = {t: i for i, t in self.text.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        made = -1
        for a, b in model["merges"]:
            m = vocab[a.removesuffix(suffix) + b if a.endswith(suffix) else a + b]
            if m <= made:
                raise ValueError("ids do not follow the order of the merges")
            made = m
            self.pair[vocab[a], vocab[b]] = m
            self.split.setdefault(m, (vocab[a], vocab[b]))
        self.auto = ahocorasick.Automaton()
        for t, i in self.id.items():
            if i in self.split or len(t.rstrip(END)) == 1:
                self.auto.add_word(t, (i, len(t)))
        self.auto.make_automaton()
        self.shorter = {i: self._prefix(t) for t, i in self.id.items()}
        self.size = {i: len(t) for t, i in self.id.items()}
        self.fits: dict[int, bool] = {}
        names = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.words.specials.items()}}
        # decoding: the UTF-8 text of token i, with the space that follows it, is bytes[offset[i]:offset[i + 1]]
        spelled = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.offset = np.r_[0, np.cumsum([len(x) for x in spelled])]

    def _prefix(self, token: str) -> int:
        for n in range(len(token) - 1, 0, -1):
            i = self.id.get(token[:n])
            if i is not None and (i in self.split or n == 1):
                return i
        return -1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges, applied to the two tokens' characters together, give the two again."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._apart(a, b, NEVER, NEVER)
        return known

    def _edge(self, token: int, side: int, absorbed: int) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is built, last first: each part, and the merge that takes it up."""
        out = [(token, absorbed)]
        while token in self.split:
            token, absorbed = self.split[token][side], token
            out.append((token, absorbed))
        return out

    def _apart(self, a: int, b: int, a_until: int, b_until: int) -> bool:
        """Whether nothing ever merges across the border of a and b, which are taken up by other merges at the times given.

        Merges happen in the order of their ids, equal ones from left to right. So two parts at the border merge if their
        merge comes before the one that takes up the left part, and not after the one that takes up the right part.
        """
        right = self._edge(b, 0, b_until)
        for x, x_until in self._edge(a, 1, a_until):
            for y, y_until in right:
                made = self.pair.get((x, y))
                if made is not None and made < x_until and made <= y_until:
                    return False
        return True

    def word(self, word: str) -> list[int]:
        """Ids of one word in the byte alphabet."""
        s = word + END
        whole = self.id.get(s)
        n = len(s)
        if whole is not None and self._stable(whole):
            return [whole]
        longest: dict[int, int] = {}

        def find(at: int) -> int:
            """The longest token at a place; one pass gives those at the places after it too."""
            for last, (i, size) in self.auto.iter_long(s, at):
                start = last - size + 1
                if start in longest:
                    break
                longest[start] = i
            return longest[at]

        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        # END belongs to the last character: no token starts with it, none may stop right before it
        at, token = 0, find(0)
        while at < n:
            while True:
                end = at + self.size[token]
                if end != n - 1 and open_[end] and (not out or self.compatible(out[-1], token)):
                    out.append(token)
                    at = end
                    if at < n:
                        token = longest[at] if at in longest else find(at)
                    break
                token = self.shorter[token]
                if token < 0:
                    open_[at] = 0
                    if not out:
                        raise ValueError(f"no path of tokens spells {word!r}")
                    token = out.pop()
                    at -= self.size[token]
        return out

    def _stable(self, token: int) -> bool:
        """Whether the merges rebuild the token from its characters: its parts are stable and stay apart until it comes."""
        key = -token - 1
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = token not in self.split or all(map(self._stable, self.split[token])) and self._apart(*self.split[token], token, token - 1)
        return known

    def piece(self, piece: str) -> bytes:
        """Ids of a run without white space."""
        ids: list[int] = []
        for special, word in self.words.of(piece):
            ids.extend([self.words.specials[word]] if special else self.word(word))
        return np.array(ids, "<u4").tobytes()

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """UTF-8 texts of documents whose ids lie one after another; tokens are joined by a space."""
        ids = ids.astype(np.int64)
        start, size = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        end = np.cumsum(size)
        flat = self.bytes[np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)].tobytes()
        bound = np.r_[0, end][np.r_[0, np.cumsum(sizes)]]
        return [flat[a : b - 1] if b > a else b"" for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int), decoded (string) of every row, in one narrow pass.

    A null or empty text gives no ids and an empty string. Repeated rows are encoded each; other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_file)
        for b, coded, plain in _both(e, batches):
            flat = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            ends = pa.array(np.r_[0, np.cumsum([len(x) // 4 for x in coded])].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(ends, flat), pa.array([x.decode() for x in plain], pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def _both(e: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[bytes]]]:
    for b in text_slices(batches, "text", 1 << 20):
        coded = e.encode(b.column("text").to_pylist())
        yield b, coded, e.decode(np.frombuffer(b"".join(coded), "<u4"), np.array([len(x) // 4 for x in coded], np.int64))


def digests(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of what `encode` gives, taken where it is made.

    A null or empty text has no ids: both digests are those of nothing. A null id stays null; repeated rows give a row each.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_file)
        for b, coded, plain in _both(e, batches):
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in plain], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Token ids of the public vocabularies, exactly as the tokenizers library gives them.

Pre-tokens are found with Python's ``re`` and looked up in a memo; the library
encodes only pre-tokens that a worker meets for the first time. That holds where
the library's normaliser and character classes are known to agree with the
patterns below: code points up to U+017F, general punctuation and the euro sign.
Any other text, and one with a special token's marks, goes to the library whole.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
from tokenizers import Tokenizer

SAFE_RANGES = ((0x00, 0x1B), (0x20, 0x17F), (0x2010, 0x203A), (0x20AC, 0x20AC))
MEMO = 1_000_000
#: Contractions that both vocabularies split off (fixed values).
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _class(test) -> str:
    """A character class of the safe code points that pass ``test``."""
    points = [c for a, b in SAFE_RANGES for c in range(a, b + 1) if test(chr(c))]
    out, at = "", 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out += f"\\u{points[at]:04x}-\\u{points[end]:04x}"
        at = end + 1
    return out


LETTER = _class(lambda c: unicodedata.category(c)[0] == "L")
NUMBER = _class(lambda c: unicodedata.category(c)[0] == "N")
SPACE = _class(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0" or unicodedata.category(c)[0] == "Z")
UNSAFE = re.compile("[^" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in SAFE_RANGES) + "]|<\\|")
WORD_PIECES = re.compile(f"{CONTRACTIONS}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
BYTE_PIECES = re.compile(
    f"{CONTRACTIONS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain_tokenizer(path: str) -> Tokenizer:
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_letters() -> dict[int, int]:
    """Code point of a byte -> the printable character byte-level vocabularies write for it.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = {}, 256
    for b in range(256):
        if b in shown:
            out[b] = b
        else:
            out[b] = free
            free += 1
    return out


BYTE_LETTERS = byte_letters()


def byte_level(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)


class PieceTable:
    """Open-addressing table from 64-bit piece hashes to row numbers, probed a whole array at a time."""

    def __init__(self, bits: int = 20):
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.full(1 << bits, -1, np.int32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if it is new."""
        mask = (1 << self.bits) - 1
        at = self._slots(hashes)
        out = self.rows[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[at] != hashes))
        while len(todo):
            at[todo] = (at[todo] + 1) & mask
            out[todo] = self.rows[at[todo]]
            todo = todo[(out[todo] >= 0) & (self.keys[at[todo]] != hashes[todo])]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """New, distinct hashes take the next rows in order; the table stays half empty."""
        new = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        if self.n + len(hashes) > 1 << (self.bits - 1):
            old = self.rows >= 0
            hashes, new = np.append(self.keys[old], hashes), np.append(self.rows[old], new)
            self.bits = max(self.bits, int(len(hashes)).bit_length() + 1)
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.rows = np.full(1 << self.bits, -1, np.int32)
        mask, keys, rows = (1 << self.bits) - 1, self.keys, self.rows
        for h, a, r in zip(hashes.tolist(), self._slots(hashes).tolist(), new.tolist()):
            while rows[a] >= 0:
                a = (a + 1) & mask
            keys[a], rows[a] = h, r
        self.n = int(new.max(initial=self.n - 1)) + 1


SPACES, LETTERS, NUMBERS, OTHERS, FOREIGN = range(5)
TABLE = 0x2100
BORDER = "\ue000"  # stands between texts, unsafe inside one


def _code_classes() -> np.ndarray:
    out = np.full(TABLE, FOREIGN, np.uint8)
    for a, b in SAFE_RANGES:
        for c in range(a, b + 1):
            kind = unicodedata.category(chr(c))[0]
            out[c] = LETTERS if kind == "L" else NUMBERS if kind == "N" else OTHERS
    for c in range(TABLE):
        if out[c] != FOREIGN and re.match(f"[{SPACE}]", chr(c)):
            out[c] = SPACES
    out[0x307] = OTHERS  # the lower case of U+0130 ends in it
    return out


class WordIds:
    """Ids of whole texts: pre-tokens are cut and looked up for a run of texts at once.

    The texts of a run are joined, lower-cased and cut by character class with
    numpy; a pre-token is known by a 64-bit polynomial hash of its characters (up
    to ``LONGEST`` of them, a text with a longer one goes to the library). One
    memo per worker, emptied when it is full.
    """

    LONGEST = 512

    def __init__(self, path: str):
        self.tok = plain_tokenizer(path)
        self.classes = _code_classes()
        rng = np.random.default_rng(20177)
        self.salt = rng.integers(1, 1 << 63, TABLE, dtype=np.uint64) | np.uint64(1)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 1
        self.back = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)
        self._reset()

    def _reset(self) -> None:
        self.table = PieceTable()
        self.flat = np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.back)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def _cut(self, code: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 position of every pre-token."""
        begin = kind != SPACES
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBERS)
        # contractions: an apostrophe that begins a piece, and the letters that follow it
        quote = np.flatnonzero((code == ord("'")) & begin)
        if len(quote):
            one, two = code[quote + 1], code[np.minimum(quote + 2, len(code) - 1)]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for at, n in ((quote[short], 2), (quote[long], 3)):
                begin[at + 1] = False
                after = at + n
                begin[after] = kind[after] != SPACES
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(code))
        gaps = np.flatnonzero(kind == SPACES)
        stop = np.searchsorted(gaps, first)
        return first, np.minimum(last, np.append(gaps, len(code))[stop])

    def _learn(self, text: str, first: np.ndarray, last: np.ndarray, hashes: np.ndarray) -> None:
        model, ids, counts = self.tok.model, [], []
        for a, b in zip(first.tolist(), last.tolist()):
            got = model.tokenize(byte_level(text[a:b]))
            counts.append(len(got))
            ids += [t.id for t in got]
        counts = np.array(counts, np.int64)
        begin = len(self.flat)
        self.starts = np.concatenate([self.starts, begin + np.cumsum(counts) - counts])
        self.lengths = np.concatenate([self.lengths, counts])
        self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])
        self.table.add(hashes)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens added."""
        if self.table.n > MEMO:
            self._reset()
        slow = {i: self._library(t) for i, t in enumerate(texts) if BORDER in t or "<|" in t}
        joined = BORDER.join("" if i in slow else t for i, t in enumerate(texts)).lower() + BORDER
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.classes[np.minimum(code, TABLE - 1)]
        border = np.flatnonzero(code == ord(BORDER))
        kind[border] = SPACES
        foreign = np.flatnonzero(kind == FOREIGN)
        for i in np.unique(np.searchsorted(border, foreign)).tolist():
            slow[i] = self._library(texts[i])
            kind[(border[i - 1] if i else 0) : border[i]] = SPACES
        first, last = self._cut(code, kind)
        for i in np.unique(np.searchsorted(border, first[last - first > self.LONGEST])).tolist():
            slow[i] = self._library(texts[i])
        fits = last - first <= self.LONGEST
        first, last = first[fits], last[fits]
        self._powers(len(code) + 1)
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(self.salt[np.minimum(code, TABLE - 1)] * self.up[: len(code)], out=sums[1:])
        hashes = (sums[last] - sums[first]) * self.down[first]
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        rows = self.table.find(hashes)
        new = np.flatnonzero(rows < 0)
        if len(new):
            unseen, where = np.unique(hashes[new], return_index=True)
            self._learn(joined, first[new[where]], last[new[where]], unseen)
            rows[new] = self.table.find(hashes[new])
        n = self.lengths[rows]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[rows] - (ends - n), n) + np.arange(total)]
        bounds = np.concatenate([[0], np.append(0, ends)[np.searchsorted(first, border)]])
        return [slow[i] if i in slow else ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def proven_whole(path: str) -> list[str]:
    """Vocabulary strings that encode alone as one token, as byte-level text.

    A string counts if it is UTF-8, is one single pre-token, and the merges bring
    it back to one token: then every pre-token equal to it counts one, whatever
    stands around it.
    """
    tok = plain_tokenizer(path)
    back = {v: k for k, v in BYTE_LETTERS.items()}
    added = {t.content for t in tok.get_added_tokens_decoder().values()}
    out = []
    for entry in tok.get_vocab(with_added_tokens=False):
        if entry in added:
            continue
        try:
            text = bytes(back[ord(c)] for c in entry).decode()
        except (UnicodeDecodeError, KeyError):
            continue
        pieces = tok.pre_tokenizer.pre_tokenize_str(text)
        if len(pieces) == 1 and pieces[0][0] == entry and len(tok.model.tokenize(entry)) == 1:
            out.append(text)
    return out


class TokenCounts(dict):
    """Memo pre-token -> number of tokens, begun with the proven whole tokens."""

    def __init__(self, path: str, whole: list[str]):
        super().__init__()
        self.tok = plain_tokenizer(path)
        self.whole = dict.fromkeys(whole, 1)
        self.update(self.whole)

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self.tok.model.tokenize(byte_level(piece)))
        return n

    def count(self, text: str) -> int:
        if UNSAFE.search(text):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        n = sum(map(self.__getitem__, BYTE_PIECES.findall(text)))
        if len(self) > MEMO:
            self.clear()
            self.update(self.whole)
        return n

"""Token ids of whole texts with a public tokenizer file, cached by word.

Byte-pair merges never cross the borders that the tokenizer's own splitting
pattern draws, and a change from a non-blank to a blank byte is always such a
border; so is a change from an ASCII letter to an ASCII sign.  Texts are
therefore cut there on the Arrow buffer, the distinct pieces of a slice are
found with a dictionary encode, and only pieces not seen before reach the
tokenizer (plain words go straight to its merge model, a slice's new ones in
calls of thousands; per-word Python was most of the cost).  ``tests/llm/test_tokens.py`` compares the ids
with plain ``encode`` calls on odd texts.

A byte-level pattern looks at the blank after a blank, so a text with blanks
outside ASCII (where the cut could fall inside such a run) stays one piece.
Slices that hold ``<|``, with which special tokens begin, are cut at blanks only.
Any tokenizer whose splitting rule is not one of the two known kinds encodes
whole texts.  NULL encodes as the empty text.
"""

from __future__ import annotations

import json
import re
from codecs import charmap_decode
from itertools import repeat

import numpy as np
import pyarrow as pa

from poststream.llm.arrowtext import BLANKS, bytes_column, codes, pieces, spans_gather, text_buffer

WIDE_BLANK = re.compile("[" + "".join(map(chr, (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
CACHE_WORDS = 200_000
CACHED_BYTES = 64
IDS_A_WORD = 16   # a full table of longer words is left before it has all its words
SPECIAL = b"<|"
# what a byte is: one table for ``bytes.translate``, a fraction of the cost of
# looking each byte up in an array
OTHER, BLANK, LETTER, SIGN = range(4)
BYTE_KIND = bytes(BLANK if b in BLANKS else OTHER if not 33 <= b < 127 or chr(b).isdigit()
                  else LETTER if chr(b).isalpha() else SIGN for b in range(256))
LOWER = bytes(range(256)).lower()   # ASCII letters alone
# letters whose normal form and lower case are one letter each, U+00C0 to U+00FE in UTF-8
PLAIN_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbe])+\Z")


def _byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 signs for themselves, the others in order from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
    return "".join(letters[b] for b in range(256))


BYTE_LETTERS = _byte_letters()


def splitting_kind(path: str) -> str:
    """How texts may be cut before the tokenizer: found once, on the driver, as
    the whole vocabulary has to be read for it."""
    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    norm = spec.get("normalizer")
    if norm is None and len(parts) == 1 and parts[0].get("type") == "ByteLevel" \
            and parts[0].get("use_regex") and not parts[0].get("add_prefix_space"):
        return "blank+word"
    split = parts[0] if parts else {}
    if split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") \
            and not parts[-1].get("add_prefix_space") and "\\s" in str(split.get("pattern")) \
            and "?!" not in str(split.get("pattern")):
        return "word"
    return "text"


class KnownWords:
    """Ids of words, end to end in one array; a dictionary has each word's number.
    Words over ``CACHED_BYTES`` have a number but are not found again."""

    def __init__(self) -> None:
        self.at: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for those not known."""
        return np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))

    def add(self, words: list[bytes], ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The numbers of new words with these ids."""
        first, before = len(self.begin), len(self.flat)
        self.begin = np.concatenate([self.begin, before + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, ids])
        numbered = zip(words, range(first, first + len(words)))
        if max(map(len, words)) > CACHED_BYTES:
            numbered = ((w, i) for w, i in numbered if len(w) <= CACHED_BYTES)
        self.at.update(numbered)
        return np.arange(first, first + len(words))


class TokenEncoder:
    """Encodes Arrow text columns; one per Python worker (see ``encoder``)."""

    def __init__(self, path: str, kind: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.kind = kind
        self.merges = Tokenizer(self.tok.model)   # the merge model alone, for plain words
        self.last = None
        if suffix := getattr(self.tok.model, "end_of_word_suffix", None):
            vocab = self.merges.get_vocab()
            self.last = np.zeros(1 + max(vocab.values()), bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.limit = cache_words
        self.young, self.old = KnownWords(), KnownWords()

    def _merged(self, letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of spelled words by the merge model.  Where the vocabulary marks a word's
        last id, one call does them all and the marks tell the words apart."""
        if self.last is not None:
            ids = np.array(self.merges.encode_batch_fast(
                [letters], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(letters) and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        found = list(map(self.merges.model.tokenize, letters))
        return (np.array([t.id for ids in found for t in ids], np.uint32),
                np.array([len(ids) for ids in found], np.int64))

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of ``words`` end to end, number of ids of each)."""
        plain = [] if self.kind == "text" else [
            i for i, w in enumerate(words) if w.isalpha() or PLAIN_WORD.match(w)]
        lens = np.zeros(len(words), np.int64)
        flat = np.zeros(0, np.uint32)
        if plain:   # no plain word holds a line end: all are spelled for the merge model at once
            joined = b"\n".join([words[i] for i in plain])
            if self.kind == "word":
                joined = joined.decode("utf-8").lower().encode("utf-8")
            letters = charmap_decode(joined, "strict", BYTE_LETTERS)[0].split(BYTE_LETTERS[10])
            flat, lens[plain] = self._merged(letters)
        rest = np.setdiff1d(np.arange(len(words)), plain).tolist()
        if rest:
            begin, place = np.cumsum(lens) - lens, np.array(rest)
            odd = [e.ids for e in self.tok.encode_batch_fast(
                [words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)]
            flat = np.concatenate([flat, np.array([i for e in odd for i in e], np.uint32)])
            more = np.array([len(e) for e in odd], np.int64)
            begin[place] = int(lens.sum()) + np.cumsum(more) - more
            lens[place] = more
            flat = flat[spans_gather(lens, begin)]
        return flat, lens

    def _lookup(self, words: list[bytes]) -> tuple[KnownWords, np.ndarray]:
        """Where the ids of ``words`` are: the table that holds them, and each word's number there."""
        young, old = self.young, self.old
        if len(young.begin) > self.limit or len(young.flat) > IDS_A_WORD * self.limit:
            # two generations: frequent words survive
            old, young = young, KnownWords()
            self.young, self.old = young, old
        number = young.numbers(words)
        miss = np.flatnonzero(number < 0)
        if len(miss):
            lost = [words[i] for i in miss]
            before = old.numbers(lost)
            kept = np.flatnonzero(before >= 0)
            if len(kept):
                lens = old.lens[before[kept]]
                number[miss[kept]] = young.add([lost[i] for i in kept],
                                               old.flat[spans_gather(lens, old.begin[before[kept]])], lens)
            new = np.flatnonzero(before < 0)
            for a in range(0, len(new), 8_000):
                part = new[a: a + 8_000]
                own = [lost[i] for i in part]
                number[miss[part]] = young.add(own, *self._plain(own))
        return young, number

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end as uint32, number of ids of each text)."""
        data, off = text_buffer(column)
        n = len(off) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[off] = True
        cut = cut[:-1]
        if self.kind != "text":
            raw = data.tobytes()
            byte = np.frombuffer(raw.translate(BYTE_KIND), np.uint8)
            blank = byte == BLANK
            mixed = SPECIAL in raw
            if not mixed:
                cut[1:] |= (byte[:-1] == LETTER) & (byte[1:] == SIGN)
        if self.kind == "word":  # blanks carry nothing: cut and drop them
            word = ~blank
            first = word & cut
            first[1:] |= word[1:] & blank[:-1]
            last = word
            last[:-1] &= blank[1:] | cut[1:]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            lens = ends - starts
            edge = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(lens, out=edge[1:])
            found = bytes_column(raw.translate(None if mixed else LOWER, bytes(BLANKS)), edge)
        else:
            if self.kind == "blank+word":
                cut[1:] |= blank[1:] & ~blank[:-1]
                for row in self._wide_rows(data, off):
                    cut[off[row]: off[row + 1]] = False
                    cut[off[row]] = True
            starts = np.flatnonzero(cut)
            found = pieces(data, starts, np.append(starts[1:], len(data)))
        code, distinct = codes(found)
        known, number = self._lookup(distinct.to_numpy(zero_copy_only=False).tolist())
        piece_len = known.lens[number][code]
        out = known.flat[spans_gather(piece_len, known.begin[number][code])]
        before = np.concatenate(([0], np.cumsum(piece_len)))
        at = before[np.searchsorted(starts, off)]
        return out, np.diff(at)

    def _wide_rows(self, data: np.ndarray, off: np.ndarray) -> list[int]:
        lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        rows = np.unique(np.searchsorted(off, lead, side="right") - 1)
        return [int(r) for r in rows
                if WIDE_BLANK.search(data[off[r]: off[r + 1]].tobytes().decode("utf-8", "replace"))]


_ENCODERS: dict[str, TokenEncoder] = {}


def encoder(path: str, kind: str) -> TokenEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()   # a worker that turns to another file lets the last one go
        _ENCODERS[path] = TokenEncoder(path, kind)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each text's ids."""
    full = counts + 1
    out = np.full(int(full.sum()), end_id, np.uint32)
    place = np.ones(len(out), bool)
    place[np.cumsum(full) - 1] = False
    out[place] = ids
    return out, full

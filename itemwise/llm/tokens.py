"""Exact ids of a ``tokenizers`` vocabulary, with each distinct word encoded once.

A text is cut before every blank (0x20) that follows a non-blank. The public
byte-level and word-end BPE vocabularies never form a token across such a
place (their pre-tokenizer starts a new piece there, special strings hold no
blank), so the ids of a text are the ids of its pieces, one after another.
Pieces repeat, so a worker remembers their ids.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import string
from array import array
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space before a blank; without it, cutting at every blank is the same.
ODD = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}] "
CUT = re.compile(r"(?<=\S)(?= )")
MARKS = string.punctuation
#: Characters of text that are cut at a time; pieces of one generation that a
#: worker remembers (about 200 bytes each, two generations); the longest piece
#: worth remembering; words of letters that are encoded as one text.
CHUNK_CHARS, REMEMBERED, LONGEST, TOGETHER = 8_400_000, 250_000, 24, 100
#: Texts that the library encodes at a time: its encodings are many times as
#: large as their ids.
AT_ONCE = 256
#: Bytes of text that operators hold at a time, and rows of texts to encode.
SLICE_BYTES, ENCODED_ROWS = 8 << 20, 4096

_encoders: dict[str, PieceEncoder] = {}


def _safe(word: str) -> bool:
    """Letters stay letters under the normalisers of the vocabularies."""
    return word.isascii() or normalize("NFC", word).lower().isalpha()


class _Words:
    """Ids of ``lead`` + word for words without white space, encoded once."""

    def __init__(self, encoder: PieceEncoder, lead: str):
        self.encoder, self.lead = encoder, lead
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # a word of letters ends with a token of the word-end kind, or begins
        # with the token of its lead
        suffix = encoder.tokenizer.model.end_of_word_suffix
        self.closes = bool(suffix)
        sign = "\u0120" if lead == " " else "\u010a"
        self.edge = np.array([t.endswith(suffix) if suffix else t.startswith(sign)
                              for t in encoder.tokens])

    def _spelled(self, words: list[str]) -> list[bytes]:
        """Words of letters: many are one text, whose ids are parted again
        where words end. A text whose parts are not as many as its words is
        encoded word by word."""
        enc, lead = self.encoder, self.lead
        groups = [words[i: i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        found = enc.encodings([lead + lead.join(g) for g in groups])
        out: list[bytes] = []
        for group, e in zip(groups, found, strict=True):
            ids = np.array(e.ids, dtype=enc.dtype)
            at = np.flatnonzero(self.edge[ids])
            ends = (at + 1 if self.closes else np.append(at[1:], len(ids))).tolist()
            if len(at) != len(group) or ends[-1] != len(ids) or not (self.closes or at[0] == 0):
                out += enc.ids([lead + w for w in group])
                continue
            raw, w = ids.tobytes(), enc.width
            out += [raw[a * w: b * w] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def remembered(self, words: list[str]) -> list[bytes | None]:
        """What is known; what the older generation knows grows young."""
        if len(self.young) > self.encoder.remembered:
            self.young, self.old = {}, self.young
        out = list(map(self.young.get, words))
        if self.old:
            old, young = self.old.get, self.young
            for i in [i for i, x in enumerate(out) if x is None]:
                x = old(words[i])
                if x is not None:
                    young[words[i]] = out[i] = x
        return out

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words that are not remembered; they are now."""
        spelled, marked, other = [], [], []
        for w in words:
            if w.isalpha() and (w.isascii() or _safe(w)):
                spelled.append(w)
                continue
            base = w.rstrip(MARKS)
            if len(base) < len(w) and base.isalpha() and _safe(base):
                marked.append((w, base, w[len(base):]))
            else:
                other.append(w)
        # ASCII marks after letters are always a piece of their own
        bases = list({base: None for _, base, _ in marked}.keys() - set(spelled))
        known = self.remembered(bases)
        spelled += [b for b, x in zip(bases, known, strict=True) if x is None]
        found = dict(zip(spelled, self._spelled(spelled), strict=True))
        base_of = found | {b: x for b, x in zip(bases, known, strict=True) if x is not None}
        tails = list({tail: None for _, _, tail in marked})
        tail_of = dict(zip(tails, self.encoder.ids(tails), strict=True))
        found.update((w, base_of[base] + tail_of[tail]) for w, base, tail in marked)
        found.update(zip(other, self.encoder.ids([self.lead + w for w in other]), strict=True))
        self.young.update(found)
        for w in [w for w in found if len(w) > LONGEST]:
            del self.young[w]
        return found

    def spell(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words of letters that are not remembered; they are now."""
        found = self._spelled(words)
        self.young.update((w, x) for w, x in zip(words, found, strict=True) if len(w) <= LONGEST)
        return found

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        out = self.remembered(words)
        new = [i for i, x in enumerate(out) if x is None]
        found = self.learn([words[i] for i in new])
        for i in new:
            out[i] = found[words[i]]
        return out


class PieceEncoder:
    """Ids as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, vocabulary: str):
        self.remembered = REMEMBERED
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.letters, self.after_blank = _Words(self, " "), _Words(self, " ")
        self.after_line = _Words(self, "\n")

    def encodings(self, texts: list[str]):
        """The library's encodings, few held at a time."""
        for i in range(0, len(texts), AT_ONCE):
            yield from self.tokenizer.encode_batch_fast(texts[i: i + AT_ONCE],
                                                        add_special_tokens=False)

    def ids(self, pieces: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.encodings(pieces)]

    def _others(self, words: list[str]) -> list[bytes]:
        """Ids of " " + word for distinct words. A single line end between
        characters other than white space is a piece, and words on both sides
        of it are pieces of their own."""
        blank = self.after_blank
        out = blank.remembered(words)
        new = [i for i, x in enumerate(out) if x is None]
        lines = {i: parts for i in new if "\n" in words[i]
                 and (parts := words[i].split("\n")) == words[i].split()}
        found = blank.learn([words[i] for i in new if i not in lines])
        for i in new:
            out[i] = found.get(words[i])
        heads = list({parts[0] for parts in lines.values()}.difference(found))
        found.update(zip(heads, blank.ids(heads), strict=True))
        rest = list({p for parts in lines.values() for p in parts[1:]})
        after = dict(zip(rest, self.after_line.ids(rest), strict=True))
        for i, parts in lines.items():
            out[i] = b"".join([found[parts[0]], *[after[p] for p in parts[1:]]])
        return out

    def _known(self, words: pa.StringArray) -> pa.Array:
        """Ids of " " + word for distinct words. Words of letters are looked up
        without the ASCII marks behind them, which are pieces of their own."""
        bases = pc.utf8_rtrim(words, MARKS)
        coded = bases.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        base = coded.indices.to_numpy()
        ids = self.letters.remembered(distinct)
        new = [i for i, x in enumerate(ids) if x is None]
        spelled = [i for i in new if distinct[i].isalpha() and _safe(distinct[i])]
        for i, x in zip(spelled, self.letters.spell([distinct[i] for i in spelled]), strict=True):
            ids[i] = x
        lettered = np.array([x is not None for x in ids], dtype=bool)[base]
        # the marks behind the letters
        ends = words.offset + np.arange(len(words) + 1)
        ends = np.frombuffer(words.buffers()[1], dtype="<i4")[ends].astype(np.int64)
        size = pc.binary_length(bases).to_numpy()
        starts = ends[:-1] + size
        marked = np.flatnonzero(lettered & (starts < ends[1:]))
        raw = memoryview(words.buffers()[2] or b"")
        tails = [bytes(raw[a:b]) for a, b in zip(starts[marked].tolist(),
                                                 ends[1:][marked].tolist(), strict=True)]
        place = {t: i for i, t in enumerate(dict.fromkeys(tails), 1)}
        tail = np.zeros(len(words), dtype=np.int64)
        tail[marked] = [place[t] for t in tails]
        tail_ids = [b"", *self.ids([t.decode() for t in place])]
        out = pc.binary_join_element_wise(
            pa.array([x or b"" for x in ids], pa.large_binary()).take(pa.array(base)),
            pa.array(tail_ids, pa.large_binary()).take(pa.array(tail)),
            pa.scalar(b"", pa.large_binary()))
        other = np.flatnonzero(~lettered)
        if not len(other):
            return out
        found = self._others(words.take(pa.array(other)).to_numpy(zero_copy_only=False).tolist())
        at = np.arange(len(words))
        at[other] = len(words) + np.arange(len(other))
        return pa.concat_arrays([out, pa.array(found, pa.large_binary())]).take(pa.array(at))

    def _join(self, pieces: pa.ListArray) -> list[bytes]:
        """Ids of texts from their pieces, all but the first without their
        leading blank; no text is without a piece."""
        coded = pieces.values.dictionary_encode()
        ends = pieces.offsets.to_numpy()
        heads = ends[:-1]
        words = self._known(coded.dictionary)
        first = self.ids(pieces.values.take(pa.array(heads)).to_pylist())
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        word[heads] = len(words) + np.arange(len(heads))
        # Arrow copies the ids of all pieces one after another
        ids = pa.concat_arrays([words, pa.array(first, pa.large_binary())]).take(pa.array(word))
        _, till, raw = ids.buffers()
        cuts = np.frombuffer(till, dtype=np.int64)[ends].tolist()
        raw = memoryview(raw or b"")
        return [bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _chunk(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        # millions of strings and no cycles: collections would only walk them
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collects:
                gc.enable()
            pa.default_memory_pool().release_unused()

    def _encoded(self, texts: list[str | None]) -> list[bytes]:
        column = pa.array([t or "" for t in texts], pa.string())
        odd = pc.match_substring_regex(column, ODD).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for rows, split in ((np.flatnonzero(~odd), self._at_blanks),
                            (np.flatnonzero(odd), self._at_words)):
            if len(rows):
                for i, ids in zip(rows, self._join(split(column.take(pa.array(rows)))),
                                  strict=True):
                    out[i] = ids
        return out

    @staticmethod
    def _at_blanks(texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(texts, " ")

    @staticmethod
    def _at_words(texts: pa.Array) -> pa.ListArray:
        cut = [CUT.split(t) for t in texts.to_pylist()]
        return pa.array([[first, *[w[1:] for w in rest]] for first, *rest in cut],
                        pa.list_(pa.string()))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; null counts as empty."""
        out: list[bytes] = []
        batch, held = [], 0
        for t in texts:
            batch.append(t)
            held += len(t or "")
            if held >= CHUNK_CHARS:
                out += self._chunk(batch)
                batch, held = [], 0
        return out + self._chunk(batch)


def give_back() -> None:
    """Hand memory that is no longer used to the system: Arrow and the C library
    keep it, and workers live from step to step."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def encoder(vocabulary: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    if vocabulary not in _encoders:
        give_back()  # what steps before left
        _encoders[vocabulary] = PieceEncoder(vocabulary)
    _encoders[vocabulary].remembered = remembered
    return _encoders[vocabulary]


def forget() -> None:
    """Free the worker's encoders before a step that encodes nothing: Spark
    keeps workers from step to step, and what they hold with them."""
    if _encoders:
        _encoders.clear()
        gc.collect()
    give_back()


def in_slices(batch, rows: int = 1024, size: int = SLICE_BYTES):
    """An Arrow batch in slices of few rows and bytes (one row at least):
    bounded memory for long texts."""
    held = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            held += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    till, first = np.cumsum(held), 0
    while first < batch.num_rows:
        before = till[first - 1] if first else 0
        last = int(np.searchsorted(till, before + size, side="right"))
        last = min(max(last, first + 1), first + rows, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last

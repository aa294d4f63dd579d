"""Token ids of whole columns of texts, by a vocabulary file of the tokenizers library.

A byte-level vocabulary takes a text apart into words before it merges bytes. It
always begins a new word after a letter that no letter follows, before white space
that follows other characters, and before the last white space that precedes one,
and after it if that is a line end; what comes before and after such a place are
encoded each for itself. Texts are cut there,
where the characters are ASCII or Latin-1, and most pieces repeat: the distinct
ones of a batch are found by Arrow, and the library encodes those that the worker
has not met yet. Pieces of letters are one word, so the library's model gets them
directly; it takes other pieces apart itself. Texts with the string of a special
token go to the library whole.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .hashing import string_hashes

END_ID = 2
#: Bytes of encoded pieces that a worker keeps; when there are more it starts anew.
KEEP_BYTES = 64 << 20
#: Bytes of text to encode at a time: what is made on the way takes some thirty times as much.
ENCODE_BYTES = 1 << 20
#: Pieces that go to the library together: it needs some hundred bytes for a token.
TOGETHER = 10_000

#: What a byte can be: an ASCII letter, a visible ASCII character that is none, a space, other white space, the lead of
#: a Latin-1 letter, and what may follow that lead (not the signs of multiplication and division).
_LETTER, _MARK, _SPACE, _LINE, _LEAD, _LATIN = 1, 2, 4, 8, 16, 32
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _MARK
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[0x20], _KINDS[[0x09, 0x0A, 0x0D]], _KINDS[0xC3], _KINDS[0x80:0xC0] = _SPACE, _LINE, _LEAD, _LATIN
_KINDS[[0x97, 0xB7]] = 0


def _letters(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte begins, and whether it ends, an ASCII or Latin-1 letter."""
    latin = ((kinds[:-1] & _LEAD) != 0) & ((kinds[1:] & _LATIN) != 0)
    begins = (kinds & _LETTER) != 0
    ends = begins.copy()
    begins[:-1] |= latin
    ends[1:] |= latin
    return begins, ends


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte of the texts, and at their end."""
    kinds, cut = _KINDS[raw], np.zeros(len(raw) + 1, bool)
    begins, letter = _letters(kinds)
    mark, line = (kinds & _MARK) != 0, (kinds & _LINE) != 0
    solid, space = letter | mark, (kinds & (_SPACE | _LINE)) != 0
    cut[1:-1] = solid[:-1] & space[1:] | letter[:-1] & mark[1:]
    seen = np.append(begins | mark, False)
    seen[offsets] = False  # a text begins: white space before it is followed by nothing
    # The last of white space before a character: it goes with the character, but a line end stays alone.
    cut[1:-2] |= space[:-2] & space[1:-1] & seen[2:-1]
    cut[2:-1] |= (solid | space)[:-2] & line[1:-1] & seen[2:-1]
    cut[offsets] = True
    return cut


class _Strings:
    """Strings one after another, with the ends of each, that grow by doubling."""

    def __init__(self, kind: type):
        self.data, self.ends, self.count = np.empty(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    def add(self, data: np.ndarray, lengths: np.ndarray) -> None:
        start = int(self.ends[self.count])
        while len(self.data) < start + len(data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        while len(self.ends) <= self.count + len(lengths):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.data[start:start + len(data)] = data
        self.ends[self.count + 1:self.count + 1 + len(lengths)] = start + np.cumsum(lengths)
        self.count += len(lengths)

    @property
    def nbytes(self) -> int:
        return self.data.nbytes + self.ends.nbytes


class _Pieces:
    """Distinct strings with their ids, numbered as they come; found by two hashes and then compared byte by byte."""

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks, self.numbers = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int32)
        self.ids, self.raw = _Strings(np.uint32), _Strings(np.uint8)

    @property
    def bytes(self) -> int:
        return sum(a.nbytes for a in (self.keys, self.checks, self.numbers, self.ids, self.raw))

    def _known(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each string that is kept, else -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        order = np.argsort(keys)  # neighbours in the table are looked up one after another
        at = np.empty(len(keys), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        kept = self.numbers[at]
        met = np.flatnonzero((self.keys[at] == keys) & (self.checks[at] == checks) & (self.raw.ends[kept + 1] - self.raw.ends[kept] == lengths))
        unlike = _gather(self.raw.data, self.raw.ends[kept[met]], lengths[met]) != _gather(raw, starts[met], lengths[met])
        same = np.ones(len(met), bool)
        same[np.searchsorted(np.cumsum(lengths[met]), np.flatnonzero(unlike), side="right")] = False
        out[met[same]] = kept[met[same]]
        return out

    def number(self, distinct: pa.Array) -> np.ndarray:
        """The numbers of distinct strings; new ones are encoded."""
        if not len(distinct):
            return np.empty(0, np.int64)
        if self.bytes > KEEP_BYTES:
            self.clear()
        offsets = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset:distinct.offset + len(distinct) + 1]
        raw = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        starts, lengths = offsets[:-1], np.diff(offsets)
        keys, checks = string_hashes(raw, starts, offsets[1:])
        out = self._known(raw, starts, lengths, keys, checks)
        new = np.flatnonzero(out < 0)
        if len(new):
            first = self.ids.count
            for i in range(0, len(new), TOGETHER):
                some = new[i:i + TOGETHER]
                fresh = _gather(raw, starts[some], lengths[some])
                self.ids.add(*self.encode(fresh, lengths[some]))
                self.raw.add(fresh, lengths[some])
            out[new] = np.arange(first, self.ids.count)
            new = new[np.argsort(keys[new])]
            place = np.searchsorted(self.keys, keys[new])
            self.keys, self.checks, self.numbers = (np.insert(a, place, v) for a, v in (
                (self.keys, keys[new]), (self.checks, checks[new]), (self.numbers, out[new].astype(np.int32))))
        return out


def _gather(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` at the starts, one after another."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return ids[at + np.repeat(starts - (ends - lengths), lengths)]


class Encoder:
    """Encodes columns of texts; one to a worker."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        #: Strings that are a token of their own wherever they stand.
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        before = tokenizer.pre_tokenizer
        #: Whether the vocabulary takes texts apart as pieces are cut.
        self.cuts = tokenizer.normalizer is None and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
        self.model, self.rest = tokenizer.model, _Pieces(self._pieces)
        #: The characters that stand for bytes in the model.
        self.names = {b: name for c in map(chr, range(0x20, 0x100)) if self.cuts for b, name in zip(c.encode(), before.pre_tokenize_str(c)[0][0])}

    @classmethod
    def of(cls, path: str) -> Encoder:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text; null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.full(len(texts), not self.cuts)
        for string in self.special:
            whole |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        lengths = np.zeros(len(texts), np.int64)
        parts: dict[bool, np.ndarray] = {}
        for hard in (False, True):
            mine = texts.filter(pa.array(whole == hard))
            if len(mine):
                parts[hard], lengths[whole == hard] = (self._whole if hard else self._by_pieces)(mine)
        if len(parts) == 1:
            return next(iter(parts.values())), lengths
        if not parts:
            return np.empty(0, np.uint32), lengths
        # Both kinds, back in the order of the texts.
        starts = np.zeros(len(texts), np.int64)
        for hard, base in ((False, 0), (True, len(parts[False]))):
            own = lengths[whole == hard]
            starts[whole == hard] = base + np.cumsum(own) - own
        return _gather(np.concatenate([parts[False], parts[True]]), starts, lengths), lengths

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self.encode([t])[0].ids, np.uint32) for t in texts.to_pylist()]
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        at = np.flatnonzero(_cuts(raw, offsets))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        names, index = self.rest.number(coded.dictionary), coded.indices.to_numpy()
        ends = self.rest.ids.ends
        starts, lengths = ends[names][index], (ends[names + 1] - ends[names])[index]
        before = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(at, offsets)]
        return _gather(self.rest.ids.data, starts, lengths), np.diff(before)

    def _pieces(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces that follow one another in the bytes, and how many each has."""
        ends = np.cumsum(lengths)
        starts = ends - lengths
        begins, ended = _letters(_KINDS[raw])
        of_word = begins | ended
        of_word[starts] |= raw[starts] == 0x20
        is_word = np.add.reduceat(~of_word, starts, dtype=np.int64) == 0
        data = raw.tobytes()
        chars, found = data.decode("latin-1").translate(self.names), [None] * len(lengths)
        for i, a, b in zip(np.flatnonzero(is_word).tolist(), starts[is_word].tolist(), ends[is_word].tolist()):
            found[i] = [token.id for token in self.model.tokenize(chars[a:b])]
        rest = self.encode([data[a:b].decode() for a, b in zip(starts[~is_word].tolist(), ends[~is_word].tolist())])
        for i, encoding in zip(np.flatnonzero(~is_word).tolist(), rest):
            found[i] = encoding.ids
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(n.sum())), n


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's, and the offsets of the texts (one more than texts)."""
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(offsets[-1], end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = ids
    return out, offsets

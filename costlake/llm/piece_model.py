"""A sentencepiece model file: its normaliser, by longest prefixes of the compiled
character map, and the spans of its pieces in the text as it was.

``Normaliser`` turns a text into what the model segments and records, for every
byte of the result, the byte of the text where its unit began. The library
segments that result with a model whose own normaliser is switched off, so a
piece of so many bytes projects to a span of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

# Fixed values of the model file: fields of its parts, kinds of pieces, the space mark.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
CHAR_MAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE_SPACE = 2, 3, 4, 5
SPACE_AS_SUFFIX = 24
MODEL_TYPE, BPE = 3, 2
USER_DEFINED = 4
SPACE_MARK = "▁".encode()
# A normaliser that changes nothing: empty map, no prefix, spaces as they are.
NO_NORMALIZER = b"\x1a\x08\x12\x00\x18\x00\x20\x00\x28\x00"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            out |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return out

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[tag & 7] if tag & 7 != 2 else varint()
        yield tag >> 3, data[at:at + size]
        at += size


def is_bpe(model: bytes) -> bool:
    """Whether the pieces are merged by byte-pair encoding."""
    trainer: dict[int, int | bytes] = {}
    for number, value in fields(model):
        if number == TRAINER:
            trainer.update(fields(value))
    return trainer.get(MODEL_TYPE) == BPE


class CharMap:
    """The compiled character map: a double array of prefixes, each with the
    place of its replacement in a list of zero-ended strings."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
        self.words = np.frombuffer(blob, np.uint8, offset=4 + size)
        self.ends = np.flatnonzero(self.words == 0)

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place: length of the longest prefix in the map (0: none), and
        where its replacement starts. All places take one step at a time."""
        length, word = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        live, step = np.arange(len(at)), 0
        node = np.repeat(self._offset(self.units[:1]), len(at))
        while len(live):
            inside = at[live] + step < len(text)
            live, node = live[inside], node[inside]
            c = text[at[live] + step].astype(np.int64)
            node = node ^ c
            known = node < len(self.units)
            live, node, c = live[known], node[known], c[known]
            unit = self.units[node]
            hit = unit & 0x800000FF == c
            live, node, unit = live[hit], node[hit] ^ self._offset(unit[hit]), unit[hit]
            step += 1
            leaf = unit >> 8 & 1 == 1
            length[live[leaf]] = step
            word[live[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return length, word

    def word_length(self, word: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, word)] - word


class Normaliser:
    def __init__(self, model: bytes):
        spec: dict[int, int | bytes] = {}
        symbols, trainer = [], {}
        for number, value in fields(model):
            if number == NORMALIZER:
                spec.update(fields(value))
            elif number == TRAINER:
                trainer.update(fields(value))
            elif number == PIECES and (piece := dict(fields(value))).get(3, 1) == USER_DEFINED:
                symbols.append(piece[1])
        self.map = CharMap(spec[CHAR_MAP]) if spec.get(CHAR_MAP) else None
        self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE_SPACE))
        self.as_suffix = bool(trainer.get(SPACE_AS_SUFFIX, 0))
        longest_first = b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))
        self.symbols = re.compile(b"(?=(" + longest_first + b"))", re.S) if symbols else None

    def _units(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Consecutive units of the text: where each starts, where its result
        starts in ``pool`` and how long that is; and the pool."""
        text = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(text & 0xC0 != 0x80)
        size = np.diff(at, append=len(text))
        if self.map is None and self.symbols is None:
            return at, at, size, text
        took, word = self.map.longest(text, at) if self.map else (np.zeros(len(at), np.int64),) * 2
        mapped = took > 0
        if self.symbols:
            for m in self.symbols.finditer(data):
                k = np.searchsorted(at, m.start())
                took[k], mapped[k] = len(m[1]), False
        # A unit of several characters swallows the starts inside it.
        first, end = np.ones(len(at), bool), 0
        for k in np.flatnonzero(took > size):
            if at[k] >= end:
                end = at[k] + took[k]
                first[k + 1:np.searchsorted(at, end)] = False
        length = np.where(took > 0, took, size)
        source = at.copy()
        if self.map:
            length[mapped] = self.map.word_length(word[mapped])
            source[mapped] = len(text) + word[mapped]
            text = np.concatenate([text, self.map.words])
        return at[first], source[first], length[first], text

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and for its end the byte
        of the text that it comes from."""
        if not data:
            return b"", np.zeros(1, np.int64)
        at, source, length, pool = self._units(data)
        lead, n = 0, len(data)
        ends = np.r_[at[1:], n]
        if self.squeeze:
            blank = (length == 1) & (pool[np.minimum(source, len(pool) - 1)] == 32)
            lead = len(blank) if blank.all() else int(np.argmin(blank))
            if lead == len(at):
                return b"", np.full(1, n)
            at, source, length, ends = at[lead:], source[lead:], length[lead:], ends[lead:]
        begin = np.cumsum(length) - length
        place = np.repeat(source - begin, length) + np.arange(int(length.sum()))
        out, back = pool[place], np.repeat(at, length)
        if self.squeeze and len(out):
            keep = self._squeezed(out, begin, length)
            out, back = out[keep], back[keep]
        if self.prefix and not self.as_suffix:
            out, back = np.r_[np.uint8(32), out], np.r_[at[:1], back]
        if self.escape:
            space = out == 32
            times = np.where(space, 3, 1)
            mark = (np.cumsum(times) - times)[space]
            out, back = np.repeat(out, times), np.repeat(back, times)
            for k, c in enumerate(SPACE_MARK):
                out[mark + k] = c
        got, last = out.tobytes(), n
        if self.squeeze:
            mark = SPACE_MARK if self.escape else b" "
            while got.endswith(mark):
                got = got[:-len(mark)]
                last = int(back[len(got)])
        back = np.r_[back[:len(got)], last]
        if self.prefix and self.as_suffix:
            mark = SPACE_MARK if self.escape else b" "
            got, back = got + mark, np.r_[back, np.full(len(mark), last)]
        return got, back

    @staticmethod
    def _squeezed(out: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which bytes stay when a unit loses its leading spaces behind a unit that
        ends with one (or at the start)."""
        full = length > 0
        begin, length = begin[full], length[full]
        unit = np.repeat(np.arange(len(length)), length)
        space = out == 32
        # places without a space before them, in their own unit
        solid = np.where(space, len(out), np.arange(len(out)))
        first = np.minimum.reduceat(solid, begin)
        ends_blank = np.r_[True, space[begin + length - 1][:-1]]
        return ~(ends_blank[unit] & (np.arange(len(out)) < np.minimum(first, begin + length)[unit]))


class Encoder:
    """Ids and original spans of texts, by ``model`` (the bytes of its file)."""

    def __init__(self, model: bytes, bos: bool = True, eos: bool = True):
        from sentencepiece import SentencePieceProcessor

        self.normalise = Normaliser(model)
        self.plain = SentencePieceProcessor(model_proto=model + NO_NORMALIZER)
        self.whole = SentencePieceProcessor(model_proto=model)
        self.bos, self.eos = bos, eos
        p, n = self.plain, self.plain.get_piece_size()
        self.size = np.array([1 if p.is_byte(i) else 0 if p.is_control(i) else len(p.id_to_piece(i).encode())
                              for i in range(n)], np.int64)
        self.unknown = p.unk_id()

    def _lengths(self, ids: np.ndarray, text: str) -> np.ndarray:
        out = self.size[ids]
        if (ids == self.unknown).any():
            for k, piece in enumerate(self.plain.encode(text, out_type=str)):
                if ids[k] == self.unknown:
                    out[k] = len(piece.encode())
        return out

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, spans) of each text: a span is [begin, end) in bytes of the text;
        begin and end ids have empty spans at its two ends. A unit that is spelt
        in several pieces belongs to the last one."""
        normal = [self.normalise(t) for t in texts]
        plain = [n.decode() for n, _ in normal]
        out = []
        for text, data, (_, back), ids in zip(plain, texts, normal, self.plain.encode(plain, num_threads=1, return_type="numpy")):
            ends = np.cumsum(self._lengths(ids, text))
            spans = np.empty((len(ids) + self.bos + self.eos, 2), "<u4")
            inner = spans[int(self.bos):len(spans) - int(self.eos)]
            inner[:, 1] = back[ends]
            inner[:, 0] = back[np.r_[0, ends[:-1]]] if len(ends) else 0
            full = np.empty(len(spans), "<u4")
            full[int(self.bos):len(full) - int(self.eos)] = ids
            if self.bos:
                full[0], spans[0] = self.plain.bos_id(), 0
            if self.eos:
                full[-1], spans[-1] = self.plain.eos_id(), len(data)
            out.append((full, spans))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode([i.astype(np.int32) for i in ids], num_threads=1) if ids else []

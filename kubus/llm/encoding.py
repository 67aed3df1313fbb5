"""Token ids of whole texts, by the tokenizers library.

Both supported kinds of byte-pair tokenizer cut a text at white space before
any merge, so the ids of a text are the ids of its pieces in order.  The
texts of a slice lie in one buffer; where pieces begin is found by byte classes
for all of them at once, equal pieces are brought together by Arrow's
dictionary encoding, and only distinct pieces are looked up.  A worker process
remembers the pieces that the library has encoded; texts repeat most of their
words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

ID_TYPE = np.dtype("<u4")
# White space as the tokenizers' own patterns see it.
_W = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters for certain, and ASCII that is none: tokenizers cut between them,
# which spares the words that differ only in the mark that follows.
_L, _MARK = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", "!-@\\[-`{-~"
# kind: (pieces of a text, a separator that is always one token of its own)
_KINDS = {
    # A single blank belongs to the word after it; other white space stands alone.
    "leading": (re.compile(rf" ?[{_L}]+(?=[{_MARK}])| ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]"), "\n"),
    # White space only separates.
    "dropped": (re.compile(rf"[{_L}]+(?=[{_MARK}])|[^{_W}]+"), " \u2605 "),
}
_BATCH = 200
# Text held as pieces at once: the more, the fewer looks a repeated piece costs.
SLICE_BYTES = 1 << 22
_PROBE = "thequickbrownfoxjumpsoverthelazydog"
# Classes of bytes; a text with white space beyond ASCII is cut by the patterns above.
_OTHER, _LETTER, _SIGN, _WHITE = range(4)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = _LETTER
_CLASS[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _SIGN
_CLASS[[*range(9, 14), 32]] = _WHITE
_WIDE_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WIDE_LEAD = np.zeros(256, bool)  # first bytes of such white space
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_CUT = re.compile(rb"(?<=[!-~])(?=[\t-\r ])")


def _begins(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts that begin at ``texts`` begin in ``data``."""
    kind = _CLASS[data]
    # Letters of two bytes: C3 and any but the two signs among them.
    lead = np.flatnonzero(data == 0xC3)
    sign = (data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7)
    kind[lead[sign]] = _OTHER
    kind[lead[~sign] + 1] = _LETTER
    white = kind == _WHITE
    begin = np.zeros(len(data), bool)
    begin[1:] = white[1:] != white[:-1]
    begin[texts[texts < len(data)]] = True
    first = np.zeros(len(data), bool)
    first[texts[texts < len(data)]] = True
    words = np.flatnonzero(begin & ~white)
    # The white space before a word: its last blank belongs to the word, any
    # other last one stands alone, what is before that is one piece.
    after = words[~first[words]]
    begin[after - 1] = True
    begin[after] = data[after - 1] != 0x20
    # A word's leading letters end where a sign follows.
    words = words[kind[words] == _LETTER]
    stops = np.append(np.flatnonzero(kind != _LETTER), len(data))
    ends = stops[np.searchsorted(stops, words)]
    limit = np.append(texts, len(data))[np.searchsorted(texts, words, "right")]
    ends = ends[ends < limit]
    begin[ends[kind[ends] == _SIGN]] = True
    return np.flatnonzero(begin)


class Encoder:
    """Encodes texts with one tokenizer file.

    ``cache_size`` bounds the pieces kept in each of two generations (a full
    young one becomes the old one; pieces still in use return from it),
    ``slice_bytes`` how much text is held as pieces at once.
    """

    def __init__(self, path: str, kind: str, cache_size: int = 250_000,
                 slice_bytes: int = SLICE_BYTES) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)  # every piece reaches the library once
        # Strings of added tokens are cut out before anything else, as the library does.
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content)
               for t in added):
            raise ValueError("added tokens must be plain strings without white space")
        self.cut_added = re.compile("(" + "|".join(re.escape(t.content) for t in added) + ")")
        self.find_added = re.compile("|".join(re.escape(t.content) for t in added).encode())
        self.pieces, self.separator = _KINDS[kind]
        self.bare = kind == "dropped"  # white space is no part of a piece
        self.mark = self._encode([self.separator])[0]
        if len(self.mark) != 1:
            raise ValueError("the separator must be one token")
        # Of plain small letters the lower-casing kind's normaliser and cutter change
        # nothing, so the library's model takes them as they are.
        self.model = self.tokenizer.model
        if self.bare and self._plain(_PROBE) != self._encode([_PROBE])[0].tobytes():
            raise ValueError("small letters must reach the model unchanged")
        self.cache_size, self.slice_bytes = cache_size, slice_bytes
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, ID_TYPE)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, letters: str) -> bytes:
        """Ids of a piece of small ASCII letters."""
        return np.array([token.id for token in self.model.tokenize(letters)], ID_TYPE).tobytes()

    def _encode_pieces(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        # A piece that could merge with the separator is encoded by itself.
        sign = self.separator.strip(" ")
        alone = [t for t in texts if sign in t or not t or t.isspace()]
        yield from zip(alone, [ids.tobytes() for ids in self._encode(alone)])
        if alone:
            texts = [t for t in texts if not (sign in t or not t or t.isspace())]
        groups = [texts[i:i + _BATCH] for i in range(0, len(texts), _BATCH)]
        for group, ids in zip(groups, self._encode([self.separator.join(g) for g in groups])):
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(group) - 1:
                raise AssertionError("a piece holds the separator's token")
            data = ids.tobytes()
            starts = [0, *((cuts + 1) * 4).tolist()]
            ends = [*(cuts * 4).tolist(), len(data)]
            yield from zip(group, [data[i:j] for i, j in zip(starts, ends)])

    def _learn(self, pieces: set[bytes]) -> None:
        """Enter pieces that the young generation lacks."""
        if len(self.known) + len(pieces) > self.cache_size:
            self.old, self.known = self.known, {}
        kept = pieces & self.old.keys()
        self.known.update(zip(kept, map(self.old.__getitem__, kept)))
        raw = list(pieces - kept)
        texts = [p.decode() for p in raw]
        if self.bare:
            texts = [t.strip(" \t\n\v\f\r") for t in texts]
        other, ids = dict.fromkeys(texts), {}
        if self.bare:
            ids = {t: self._plain(t) for t in other if t.isascii() and t.isalpha() and t.islower()}
            other = [t for t in other if t not in ids]
        ids.update(self._encode_pieces(list(other)))
        self.known.update(zip(raw, map(ids.__getitem__, texts)))

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece; only pieces not known yet cost more than a look."""
        found = list(map(self.known.get, pieces))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            self._learn({pieces[i] for i in missing})
            for i in missing:
                found[i] = self.known[pieces[i]]
        return found

    def _odd(self, text: str) -> bytes:
        """Ids of a text with an added token or white space beyond ASCII."""
        pieces = [p.encode() for i, between in enumerate(self.cut_added.split(text))
                  for p in ([between] if i % 2 else self.pieces.findall(between))]
        return b"".join(self._look_up(pieces))

    def _slice(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each of the ``parts``, together about a slice."""
        buffer = b"".join(parts)
        ends = np.cumsum([len(part) for part in parts])
        wide = np.flatnonzero(_WIDE_LEAD[np.frombuffer(buffer, np.uint8)])
        odd = {i for i in np.unique(np.searchsorted(ends, wide, "right")).tolist()
               if _WIDE_WHITE.search(parts[i].decode())}
        if self.find_added.search(buffer):
            odd |= {i for i, part in enumerate(parts) if self.find_added.search(part)}
        if odd:
            buffer = b"".join([b"" if i in odd else part for i, part in enumerate(parts)])
        sizes = [0 if i in odd else len(part) for i, part in enumerate(parts)]
        texts = np.cumsum([0, *sizes])[:-1]
        out = [b""] * len(parts)
        if self.bare:  # its normaliser lower-cases, so the forms of a word are one piece
            buffer = buffer.lower()
        if buffer:
            begins = _begins(np.frombuffer(buffer, np.uint8), texts)
            offsets = np.append(begins, len(buffer)).astype(np.int32)
            pieces = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [
                None, pa.py_buffer(offsets), pa.py_buffer(buffer)]).dictionary_encode()
            found = self._look_up(pieces.dictionary.to_pylist())
            which = pieces.indices.to_numpy()
            counts = np.fromiter(map(len, found), np.int32, len(found)) >> 2
            at = (np.cumsum(counts, dtype=np.int32) - counts)[which]
            counts = counts[which]
            ends = np.cumsum(counts, dtype=np.int32)
            # The place of every id of the slice among the distinct pieces' ids.
            place = np.repeat(at - ends + counts, counts)
            place += np.arange(len(place), dtype=np.int32)
            ids = np.frombuffer(b"".join(found), ID_TYPE)[place].tobytes()
            # Ids before each text: those of the pieces before its first one.
            upto = np.append(0, ends)[np.searchsorted(begins, np.append(texts, len(buffer)))] * 4
            out = [ids[i:j] for i, j in zip(upto[:-1].tolist(), upto[1:].tolist())]
        for i in odd:
            out[i] = self._odd(parts[i].decode())
        return out

    def _slices(self, text: bytes) -> Iterator[bytes]:
        at = 0
        while len(text) - at > self.slice_bytes:
            cut = _CUT.search(text, at + self.slice_bytes)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers; null
        and empty texts have none."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            for (i, _), ids in zip(held, self._slice([part for _, part in held])):
                out[i].append(ids)
            held.clear()

        for i, text in enumerate(texts):
            for part in self._slices((text or "").encode()):
                held.append((i, part))
                size += len(part)
                if size >= self.slice_bytes:
                    flush()
                    size = 0
        if held:
            flush()
        return [b"".join(parts) for parts in out]


@cache
def encoder(path: str, kind: str, cache_size: int = 250_000) -> Encoder:
    """One encoder per worker process, tokenizer file and kind."""
    return Encoder(path, kind, cache_size)

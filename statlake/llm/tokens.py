"""Token ids of whole texts by the ``tokenizers`` library, fast on repeated words.

A byte-level BPE tokenizer splits a text before merging, and a single space
between two non-space characters always starts a new piece. So a text is cut
there, each distinct chunk is encoded by the library once per worker, and the
chunks' ids are joined: the same ids as encoding the whole text, which
``tests/llm`` checks against the library on odd texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from statlake.llm.common import slices

_CUT = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``held`` are chunks seen before, with their ids in one flat array: no Python
    objects, so about 40 bytes a chunk. When there are too many, only those of the
    texts at hand stay, so memory is bounded on any vocabulary. That only saves
    time: a chunk not held is encoded again.
    """

    HELD = 400_000

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.held = pa.array([], pa.large_string())
        self.ids, self.begin = _joined([])
        size = self.model.get_vocab_size(with_added_tokens=True)
        # does the token begin with a space? (byte-level BPE writes it as U+0120)
        self.spaced = np.zeros(size, dtype=bool)
        for token, i in self.model.get_vocab(with_added_tokens=True).items():
            self.spaced[i] = token.startswith("Ġ")
        self.chunked = self._is_byte_level()

    def _is_byte_level(self) -> bool:
        import json

        spec = json.loads(self.model.to_str())
        pre = spec.get("pre_tokenizer") or {}
        return (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
            and all(" " not in t["content"] for t in spec.get("added_tokens", []))
        )

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, chunks: pa.Array) -> None:
        """Encode " " + chunk for chunks not held, and hold them."""
        flats, sizes = [self.ids], [np.diff(self.begin)]
        for lo in range(0, len(chunks), 5000):
            part = chunks.slice(lo, 5000).to_pylist()
            # white space other than a space inside a chunk changes nothing: the
            # chunk still has one leading space; at its ends it may join others
            odd = [c for c in part if c[:1].isspace() or c[-1:].isspace() or " " in c]
            own = dict(zip(odd, self.whole([" " + c for c in odd]), strict=True))
            if plain := [c for c in part if c not in own]:
                ids = np.array(self.model.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)[0].ids, dtype="<u4")
                cut = np.flatnonzero(self.spaced[ids])
                raw, at = ids.tobytes(), (cut * 4).tolist() + [len(ids) * 4]
                own.update((c, raw[a:b]) for c, a, b in zip(plain, at[:-1], at[1:], strict=True))
            ids, at = _joined(list(map(own.__getitem__, part)))
            flats.append(ids)
            sizes.append(np.diff(at))
        self.held = pa.concat_arrays([self.held, chunks])
        self.ids, self.begin = np.concatenate(flats), _edges(np.concatenate(sizes))

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """The place in ``held`` of each of the distinct chunks; those not held are learned."""
        found = pc.index_in(chunks, value_set=self.held)
        if len(self.held) > self.HELD:
            known = found.drop_null()
            self.ids, self.begin = _taken(self.ids, self.begin, known.to_numpy())
            self.held = self.held.take(known)
            found = pc.index_in(chunks, value_set=self.held)
        new = found.is_null().to_numpy(zero_copy_only=False)
        places = found.fill_null(0).to_numpy().astype(np.int64)
        places[new] = len(self.held) + np.arange(np.count_nonzero(new))
        if new.any():
            self._learn(chunks.filter(pa.array(new)))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the n+1 offsets of the texts in
        them. Whole texts, no special tokens added; NULL reads as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if not self.chunked:
            return _joined(self.whole(texts.to_pylist()))
        words = pc.split_pattern(texts, " ")
        at = words.offsets.to_numpy().astype(np.int64)
        words, at = words.values[at[0] : at[-1]], at - at[0]
        coded = words.dictionary_encode()
        # texts with an empty chunk (a leading, trailing or double space) are cut with care
        empty = np.flatnonzero(pc.binary_length(words).to_numpy() == 0)
        odd = np.unique(np.searchsorted(at, empty, side="right") - 1)
        odd = odd[at[odd + 1] - at[odd] > 1] if len(odd) else odd
        heads, head_at = _joined(self.whole(words.take(pa.array(at[:-1])).to_pylist()))
        del words
        places = self._places(coded.dictionary)
        # per word: the ids of " " + word, but for a text's first word those without the space
        index = places[coded.indices.to_numpy()]
        index[at[:-1]] = len(self.held) + np.arange(n)
        del coded, places
        begin = np.concatenate([self.begin, self.begin[-1] + head_at[1:]])
        out, ends = _taken(np.concatenate([self.ids, heads]), begin, index)
        at = ends[at]
        if len(odd):
            parts = [out[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            some = pa.RecordBatch.from_arrays([pa.array(odd), texts.take(pa.array(odd))], ["i", "text"])
            for few in slices(some, "text", len(odd), 1 << 20):
                cuts = [_CUT.split(text) for text in few.column("text").to_pylist()]
                first = self.whole([c[0] for c in cuts])
                coded = pa.array([chunk for c in cuts for chunk in c[1:]], pa.large_string()).dictionary_encode()
                index = self._places(coded.dictionary)[coded.indices.to_numpy()]
                rest, ends = _taken(self.ids, self.begin, index)
                ends = ends[_edges(np.array([len(c) - 1 for c in cuts]))]
                for i, head, a, b in zip(few.column("i").to_pylist(), first, ends[:-1], ends[1:], strict=True):
                    parts[i] = head + rest[a:b].tobytes()
            return _joined(parts)
        return out, at


def _edges(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    return np.frombuffer(b"".join(parts), dtype="<u4"), _edges(size)


def _taken(flat: np.ndarray, begin: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (n of them, n+1 offsets ``begin``) at ``index``, one after the other, and their offsets."""
    size = np.diff(begin)[index]
    edges = _edges(size)
    where = np.repeat(begin[index] - edges[:-1], size)
    where += np.arange(edges[-1])
    return flat[where], edges


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, held: int = Encoder.HELD) -> Encoder:
    """The worker process's encoder for a tokenizer file (loaded once per process).

    ``held`` bounds the chunks it remembers: about 40 bytes each.
    """
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].HELD = held
    return _ENCODERS[path]

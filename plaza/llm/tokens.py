"""Token ids of whole texts by the tokenizers library, with a bounded table of pieces met before."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space by Python's account, which holds all that engines class so.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Characters whose kind all versions of Unicode agree on: letters, and punctuation without the apostrophe of "'s".
LETTER, PUNCTUATION = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
MARK = "\x01"  # cuts; a text that holds it is encoded whole

KEPT_BYTES = 64  # longer pieces are not kept
MOST_PIECES = 300_000  # kept by a Python worker; beyond them the half met most often stays
JOINED = 256  # words that are encoded as one text
CALL = 32  # texts to a call of the library


def tokenizer_file(path: str) -> str:
    """The text of a tokenizer file: the driver reads it once and tasks carry it."""
    return Path(path).read_text(encoding="utf-8")


class Encoder:
    """Encodes texts as if by ``encode_batch(..., add_special_tokens=False)``, special tokens as plain text.

    Texts are cut where the result can't change, and each distinct piece is encoded once, as most
    words of a corpus come again. A tokenizer of another kind encodes whole texts.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        kind = json.loads(spec)
        pre, model = kind.get("pre_tokenizer") or {}, kind["model"]
        ordinary = all(token.get("special") for token in kind.get("added_tokens", []))
        self.cuts = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not kind.get("normalizer") and model.get("type", "BPE") == "BPE" and not model.get("dropout")
            and not kind.get("truncation") and not kind.get("padding") and ordinary
        )
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # Ids of tokens that begin with a space, which byte-level models write as this letter.
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.cuts:
            self.spaced[[k for token, k in model["vocab"].items() if token.startswith("Ġ")]] = True
        # Pieces met before, their ids and how often they were met.
        self.known, self.coded, self.met = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int64)

    def _whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        for first in range(0, len(texts), CALL):  # the library's results take far more memory than ids
            for own in self.tokenizer.encode_batch_fast(texts[first : first + CALL], add_special_tokens=False):
                yield np.array(own.ids, self.dtype)

    def _coded(self, parts: Iterable[np.ndarray]) -> pa.Array:
        return pa.array([own.tobytes() for own in parts], pa.large_binary())

    def _new(self, pieces: pa.Array) -> pa.Array:
        """Ids of each piece. Words after a space are encoded together, as each one's first token shows its space."""
        words = pc.match_substring_regex(pieces, f"^ [^{SPACE}]+$").to_numpy(zero_copy_only=False)
        texts = pieces.filter(pa.array(words)).to_pylist()
        ids = np.concatenate([np.zeros(0, self.dtype), *self._whole(["".join(texts[k : k + JOINED]) for k in range(0, len(texts), JOINED)])])
        starts = np.append(np.flatnonzero(self.spaced[ids]), len(ids)).astype(np.int64)
        if len(starts) != len(texts) + 1:  # the vocabulary lacks the space
            return self._coded(self._whole(pieces.to_pylist()))
        joined = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(starts * self.dtype.itemsize), pa.py_buffer(ids)]
        )
        others = self._coded(self._whole(pieces.filter(pa.array(~words)).to_pylist()))
        place = np.where(words, np.cumsum(words) - 1, len(texts) + np.cumsum(~words) - 1)
        return pa.concat_arrays([joined, others]).take(pa.array(place))

    def _pieces(self, texts: pa.Array) -> pa.Array:
        """Lists of pieces, which the word pattern of byte-level models never takes as one.

        It ends a word before white space (and looks ahead within it only), after a line end on its own,
        and between a letter and punctuation.
        """
        if pc.any(pc.match_substring_regex(texts, f"[{SPACE}] ")).as_py():
            texts = pc.replace_substring_regex(texts, f"([^{SPACE}]) ", rf"\1{MARK} ")
        else:
            texts = pc.replace_substring(texts, " ", f"{MARK} ")
        texts = pc.replace_substring_regex(texts, f"([^{SPACE}])\n", rf"\1{MARK}" + "\n")
        texts = pc.replace_substring_regex(texts, f"{MARK}\n([^{SPACE}])", f"{MARK}\n{MARK}" + r"\1")
        texts = pc.replace_substring_regex(texts, f"([{LETTER}])([{PUNCTUATION}])", rf"\1{MARK}\2")
        return pc.split_pattern(texts, MARK)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and the last one's end."""
        lists = self._pieces(texts)
        before = len(self.known)
        found = pa.concat_arrays([self.known, lists.flatten()]).dictionary_encode()
        codes = found.indices.to_numpy()[before:]
        coded = pa.concat_arrays([self.coded, self._new(found.dictionary[before:])])
        out = coded.take(pa.array(codes))
        _, offsets, data = out.buffers()
        ends = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
        places = np.frombuffer(offsets, np.int64)[ends] // self.dtype.itemsize
        self._keep(found.dictionary, coded, np.bincount(codes, minlength=len(coded)))
        return np.frombuffer(data, self.dtype) if data else np.zeros(0, self.dtype), places

    def _keep(self, pieces: pa.Array, coded: pa.Array, met: np.ndarray) -> None:
        met[: len(self.met)] += self.met
        kept = np.flatnonzero(pc.less_equal(pc.binary_length(pieces), KEPT_BYTES).to_numpy(zero_copy_only=False))
        if len(kept) > MOST_PIECES:
            kept = kept[np.argpartition(-met[kept], MOST_PIECES // 2)[: MOST_PIECES // 2]]
            met //= 2
        self.known, self.coded, self.met = pieces.take(pa.array(kept)), coded.take(pa.array(kept)), met[kept]

    def ids(self, texts: Sequence[str | None] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text as an array of ``dtype``; NULL has none."""
        column = pc.fill_null(pa.array(texts, pa.string()) if not isinstance(texts, pa.Array) else texts, "").cast(pa.large_string())
        whole = pc.match_substring(column, MARK).to_numpy(zero_copy_only=False) if self.cuts else np.ones(len(column), bool)
        own = self._whole(column.filter(pa.array(whole)).to_pylist())
        if whole.all():
            yield from own
            return
        ids, places = self._cut(column.filter(pa.array(~whole)))
        cut = iter(zip(places[:-1].tolist(), places[1:].tolist(), strict=True))
        for alone in whole.tolist():
            yield next(own) if alone else ids[slice(*next(cut))]


@functools.lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(spec)

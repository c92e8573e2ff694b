"""Token ids of whole texts, from the tokenizers library, with a bounded memo of parts met before.

Byte-pair tokenizers split a text into pre-tokens and encode each on its own. So a text may be cut where a cut can
not change its pre-tokens, each different part be encoded once, and the ids be joined again. Parts not met before are
encoded many in one text, with a token between them that no part gives. Strings of special tokens are what the
tokenizer takes them for by itself; a text that may hold one is cut at white space alone.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tableflow.llm.common import worker_memory

#: Parts remembered by a worker process, about 130 bytes each; a dict of more is twice as large.
MEMO_ENTRIES = 690_000
#: Bytes of texts encoded at a time, about; a part met twice among them is encoded once. Encoding takes some twenty
#: times as much memory, in each of an executor's workers.
SLICE_BYTES = 4 << 20
_CHUNK = 2_000

#: What every string of a special token begins with.
_SPECIAL = "<|"
#: Letters and digits before a mark of punctuation: a pre-token ends between them.
_BEFORE_MARK = r"([\p{L}\p{N}])([.,;:!?])"
#: What stands between parts encoded in one text: a word, or a newline.
_BETWEEN = {"words": " ~ ", "bytes": "\n"}

#: White space other than single spaces and newlines inside the text, or the mark used below: such texts are
#: encoded whole by the byte-level tokenizer.
_IRREGULAR = (
    r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b\x0c\r\x01\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


class TokenEncoder:
    """Encodes Arrow string arrays; ``split`` is ``"words"`` or ``"bytes"`` after the tokenizer's pre-tokens.

    ``"words"`` is for tokenizers that drop white space and lower-case: parts are what ASCII white space separates.
    ``"bytes"`` is for byte-level ones, whose pre-tokens begin with at most one space: a part is a word with the space
    before it, or a newline. In both, marks of punctuation behind a letter or digit begin a part of their own.
    """

    def __init__(self, path: str, split: str, memo_entries: int = MEMO_ENTRIES, slice_bytes: int = SLICE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state = worker_memory().setdefault((path, split), {})
        if not state:
            tokenizer = Tokenizer.from_file(path)
            wide = tokenizer.get_vocab_size() > 1 << 16
            between = tokenizer.encode(_BETWEEN[split].strip(" "), add_special_tokens=False).ids
            if len(between) != 1:
                raise ValueError(f"{path} has no token of its own for {_BETWEEN[split]!r}")
            state.update(tokenizer=tokenizer, memo={}, code="I" if wide else "H", between=between[0])
        self._tokenizer, self._memo, self._code = state["tokenizer"], state["memo"], state["code"]
        self._between = state["between"]
        self.dtype = np.dtype(self._code)
        self._split, self._entries, self._slice = split, memo_entries, slice_bytes

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), _CHUNK):
            for one in self._tokenizer.encode_batch_fast(texts[i : i + _CHUNK], add_special_tokens=False):
                yield array(self._code, one.ids).tobytes()

    def _encode_together(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of short texts that do not hold what stands between them."""
        between, size = _BETWEEN[self._split], self.dtype.itemsize
        for i in range(0, len(texts), _CHUNK):
            some = texts[i : i + _CHUNK]
            [one] = self._tokenizer.encode_batch_fast([between.join(some) + between], add_special_tokens=False)
            ids = np.array(one.ids, self.dtype)
            ends = np.flatnonzero(ids == self._between)
            if len(ends) != len(some):
                yield from self._encode(some)
                continue
            raw = ids.tobytes()
            for a, b in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist()):
                yield raw[a * size : b * size]

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        memo = self._memo
        found = list(map(memo.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        texts = [self._text_of(parts[i]) for i in missing]
        mark = _BETWEEN[self._split].strip(" ")
        alone = [not t or mark in t or _SPECIAL in t for t in texts]
        together = self._encode_together([t for t, one in zip(texts, alone) if not one])
        apart = self._encode([t for t, one in zip(texts, alone) if one])
        for i, one in zip(missing, alone):
            found[i] = ids = next(apart if one else together)
            if len(memo) < self._entries:
                memo[parts[i]] = ids
        return found

    def _text_of(self, part: str) -> str:
        if self._split == "words" or part == "\n":
            return part
        return part[1:] if part[:1] == "\x01" else " " + part

    def _parts(self, texts: pa.Array) -> pa.Array:
        plain = pc.invert(pc.match_substring(texts, _SPECIAL))
        if self._split == "words":
            cut = pc.replace_substring_regex(pc.ascii_lower(texts), _BEFORE_MARK, r"\1 \2")
            return pc.ascii_split_whitespace(pc.if_else(plain, cut, texts))
        cut = pc.if_else(plain, pc.replace_substring_regex(texts, _BEFORE_MARK, "\\1 \x01\\2"), texts)
        marked = pc.replace_substring(pc.binary_join_element_wise("\x01", cut, ""), "\n", " \n \x01")
        return pc.split_pattern(marked, " ")

    def encode_batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """From batches of an id and a text column: the first, and what ``encode`` gives, for some rows at a time."""
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // self._slice)) + 1
            for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                some = batch.slice(at, end - at)
                yield some.column(0), *self.encode(some.column(1))
            # What Arrow keeps of it would stay with the worker, which outlives the task.
            batch = some = None
            pa.default_memory_pool().release_unused()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins and the last ends; null is empty."""
        texts = pc.fill_null(texts, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        whole = np.zeros(len(texts), bool)
        if self._split == "bytes":
            whole = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        fast = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        listed = self._parts(fast)
        first = listed.offsets.to_numpy()
        coded = listed.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        known = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(known), dtype=self.dtype)
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        start = np.cumsum(size) - size
        code = coded.indices.to_numpy()
        each = size[code]
        end = np.concatenate([[0], np.cumsum(each)])
        # Positions in the row of ids, in the narrowest type that holds them.
        wide = np.int32 if max(end[-1], len(flat)) < 1 << 31 else np.int64
        at = np.repeat((start[code] - end[:-1]).astype(wide), each)
        at += np.arange(end[-1], dtype=wide)
        ids = flat[at]
        ends = end[first - first[0]]
        if not whole.any():
            return ids, ends
        rest = iter(self._encode(texts.filter(pa.array(whole)).to_pylist()))
        pieces = [
            np.frombuffer(next(rest), self.dtype) if whole[i] else ids[ends[i] : ends[i + 1]] for i in range(len(whole))
        ]
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

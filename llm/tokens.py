"""Encoding of text batches by public tokenizers, and counts of tokens.

A batch is cut at boundaries that no token crosses, its distinct parts are encoded once, and the
parts' ids (or only their lengths) are put together again with numpy. Results equal the library's
on the whole text:

* SentencePiece without pieces that hold a word's end and the next space: a text is cut before a
  space that follows something else; the library's own leading space stands for the one taken away.
* A ``tokenizers`` file that drops white space: a text is cut at spaces, tabs and line ends.
* Any other file: whole texts.

Nulls are empty texts; an empty text has no tokens.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from llm.common import gather_runs, ids_and_texts, per_row, sizes_of, sliced, texts_of, tokenizer_file

#: Bytes of text encoded at a time.
BATCH_BYTES = 4 << 20

_BREAK = re.compile("(?<=[^ ▁]) (?=.)", re.DOTALL)


class _Pieces:
    """SentencePiece."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self._model.id_to_piece(i) for i in range(self._model.get_piece_size()))
        probe = "a  b c "
        self._cuts = not any("▁" in p.lstrip("▁") for p in pieces) and self._lengths([probe])[0] == sum(self._lengths(_BREAK.split(probe)))

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self._model.encode(texts, num_threads=1)] if texts else []

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Parts of all texts, and how many each text has."""
        if not self._cuts:
            return texts, np.ones(len(texts), dtype=np.int64)
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, "▁")), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        if not pc.any(odd).as_py():
            split = pc.split_pattern(texts, " ")
            return split.flatten(), np.diff(split.offsets.to_numpy())
        if pc.all(odd).as_py():
            lists = [_BREAK.split(t) for t in texts.to_pylist()]
            return pa.array([p for x in lists for p in x], pa.string()), np.array([len(x) for x in lists], dtype=np.int64)
        flags = odd.to_numpy(zero_copy_only=False)
        order = np.concatenate((np.flatnonzero(~flags), np.flatnonzero(flags)))
        (a, an), (b, bn) = (self.parts(texts.filter(pa.array(x))) for x in (~flags, flags))
        counts = np.concatenate((an, bn))
        back = np.argsort(order)
        starts = np.cumsum(counts) - counts
        return pa.concat_arrays([a, b]).take(pa.array(gather_runs(starts[back], counts[back]))), counts[back]

    def lengths(self, parts: list[str]) -> np.ndarray:
        return np.array(self._lengths(parts), dtype=np.int64)


class _Words:
    """A file of the ``tokenizers`` library."""

    #: A mark that is one token and nothing else; distinct parts are encoded many to a call between marks.
    MARKS = "♥★☆♡→•"
    TOGETHER, CALL = 512, 16

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.no_truncation()
        self._model.no_padding()
        probe = " Ab  cd,\n\te's "
        alone = [i for part in probe.split() for i in self._encode([part])[0]]
        #: White space is dropped, and a letter and what follows it are split at a closing mark.
        self._cuts = self._encode([probe])[0] == alone and self._encode(["ab. cd"]) == self._encode(["ab . cd"])
        self._lowers = self._encode(["AZ aZ"]) == self._encode(["az az"])
        self._mark = next((m for m in self.MARKS if len(self._encode([m])[0]) == 1 and self._encode([f"a {m} b"])[0] == [i for t in ("a", m, "b") for i in self._encode([t])[0]]), None) if self._cuts else None
        self._mark_id = self._encode([self._mark])[0][0] if self._mark else -1

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        if not self._cuts:
            return texts, np.ones(len(texts), dtype=np.int64)
        for space in ("\n", "\t"):
            texts = pc.replace_substring(texts, space, " ")
        # Special tokens are matched before letters become lower case, so their look is left alone.
        if self._lowers and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring_regex(texts, "([A-Za-z])([.,;:!?])( |$)", "\\1 \\2\\3")
        split = pc.split_pattern(texts, " ")
        return split.flatten(), np.diff(split.offsets.to_numpy())

    def ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and how many each has."""
        alone = [i for i, p in enumerate(parts) if self._mark is None or self._mark in p or "<|" in p]
        apart = dict(zip(alone, self._encode([parts[i] for i in alone]), strict=True))
        plain = ["" if i in apart else p for i, p in enumerate(parts)] if apart else parts
        flat, lengths = [], []
        size = self.TOGETHER * self.CALL
        for at in range(0, len(plain) if self._mark else 0, size):
            joined = [f" {self._mark} ".join(plain[i : i + self.TOGETHER]) for i in range(at, min(at + size, len(plain)), self.TOGETHER)]
            for ids in self._encode(joined):
                ids = np.array(ids, dtype=np.uint32)
                marks = np.flatnonzero(ids == self._mark_id)
                lengths.append(np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1)
                flat.append(np.delete(ids, marks))
        if not flat:
            lengths, flat = [np.zeros(len(parts), dtype=np.int64)], [np.zeros(0, dtype=np.uint32)]
        count, flat = np.concatenate(lengths), np.concatenate(flat)
        if apart:
            starts = np.cumsum(count) - count
            flat = np.insert(flat, np.repeat(starts[alone], [len(apart[i]) for i in alone]), [x for i in alone for x in apart[i]])
            count[alone] = [len(apart[i]) for i in alone]
        return flat, count

    def lengths(self, parts: list[str]) -> np.ndarray:
        return self.ids(parts)[1]


@functools.cache
def library(name: str) -> _Pieces | _Words:
    """One model a worker process; Spark runs the tasks side by side, the library none of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = tokenizer_file(name)
    return _Words(path) if path.endswith(".json") else _Pieces(path)


def token_counts(texts: pa.Array, name: str) -> np.ndarray:
    model = library(name)
    parts, counts = model.parts(texts)
    coded = parts.dictionary_encode()
    lengths = model.lengths(coded.dictionary.to_pylist())
    return per_row(lengths[coded.indices.to_numpy()] if len(lengths) else np.zeros(0, dtype=np.int64), counts)


def token_ids(texts: pa.Array, name: str, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each has; ``end`` closes each text."""
    model = library(name)
    parts, counts = model.parts(texts)
    coded = parts.dictionary_encode()
    flat, lengths = model.ids(coded.dictionary.to_pylist())
    index = coded.indices.to_numpy().astype(np.int64)
    if end is not None:
        index = np.insert(index, np.cumsum(counts), len(lengths))
        counts = counts + 1
        flat, lengths = np.append(flat, np.uint32(end)), np.append(lengths, 1)
    starts = np.cumsum(lengths) - lengths
    return flat[gather_runs(starts[index], lengths[index])], per_row(lengths[index], counts)


def count_tokens(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", limit: int = 4096, batch_bytes: int = BATCH_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit. Only lengths leave the task.

    Rows are encoded in batches of about ``batch_bytes``. Null texts count as empty; repeated rows and
    null ids give a row each; other columns are not read. No shuffle."""
    chosen = ids_and_texts(docs, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            sizes = sizes_of(texts)
            found = [token_counts(texts.slice(a, b - a), tokenizer) for a, b in sliced(sizes, batch_bytes)]
            n = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return chosen.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

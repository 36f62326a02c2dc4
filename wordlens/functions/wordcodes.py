"""Sentences as numbers of a dictionary of their own group, in Arrow batches.

The steps are closures that import what they need where they run, so that a worker needs no copy
of this package.  Strings are compared and carried as the bytes they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

#: tokens looked at once
SLICE_TOKENS = 500_000
#: a group ends with the slice that brings it to so many cells or so many words
GROUP_CELLS = 2_000_000
GROUP_WORDS = 500_000
#: words of one row of a dictionary
WORDS_A_ROW = 4096


def _packing() -> tuple[Callable, Callable]:
    """Numbers below 2**63 as bytes, seven bits a byte, and back."""

    def packed(numbers, per):
        """``numbers``, of which the rows have ``per`` each -> a binary array of these rows."""
        import numpy as np
        import pyarrow as pa

        length = np.ones(len(numbers), np.int64)
        for k in range(7, 63, 7):
            length += numbers >= 1 << k
        ends = np.append(0, np.cumsum(length))
        out = np.empty(ends[-1], np.uint8)
        for k in range(int(length.max(initial=0))):
            at = np.flatnonzero(length > k)
            out[ends[at] + k] = (numbers[at] >> 7 * k & 127) | ((length[at] > k + 1) << 7)
        rows = ends[np.append(0, np.cumsum(per))].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(per), [None, pa.py_buffer(rows), pa.py_buffer(out)])

    def unpacked(column):
        """A binary column -> the numbers of all its rows, and how many each row has."""
        import numpy as np
        import pyarrow as pa

        parts, per = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
            rows = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, chunk.offset * 4)
            data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)[rows[0]:rows[-1]]
            last = data < 128
            ends = np.append(0, np.cumsum(last))
            per.append(np.diff(ends[rows - rows[0]]))
            if len(data):
                first = np.append(0, np.flatnonzero(last)[:-1] + 1)
                shift = 7 * (np.arange(len(data)) - first[ends[:-1]])
                parts.append(np.add.reduceat((data & 127).astype(np.int64) << shift, first))
        return np.concatenate(parts), np.concatenate(per)

    return packed, unpacked


def coder(keys: Sequence[str]) -> Callable[[Iterator], Iterator]:
    """Batches of ``keys`` and ``_lv array<string>`` -> rows of sentences and rows of words.

    A sentence's row has its keys, ``_group``, ``_codes`` and ``_counts``; one without words (NULL
    is none) gives no row.  Its codes are ascending, none twice; kept are the steps between them,
    doubled, odd where a word has more occurrences than one, and the counts of these words.  A row
    of words has ``_group``, ``_words`` and ``_first``, the code of the first of them.  A group is
    a run of sentences of one task: a task holds the words of one group and the cells of one slice.
    """
    keys, slice_tokens, words_a_row = list(keys), SLICE_TOKENS, WORDS_A_ROW
    most_cells, most_words, (packed, _) = GROUP_CELLS, GROUP_WORDS, _packing()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        group, cells, words, kinds = TaskContext.get().partitionId() << 32, 0, pa.array([], pa.string()), {}
        own = {"_codes": pa.binary(), "_counts": pa.binary(), "_first": pa.int32(), "_words": pa.list_(pa.string())}

        def rows(n: int, columns: dict):
            out = {k: columns.get(k, pa.nulls(n, kind)) for k, kind in (kinds | own).items()}
            return pa.RecordBatch.from_pydict(out | {"_group": pa.array(np.full(n, group))})

        def dictionary():
            first = np.arange(0, len(words), words_a_row, dtype=np.int32)
            ends = pa.array(np.append(first, len(words)).astype(np.int32))
            return rows(len(first), {"_first": pa.array(first), "_words": pa.ListArray.from_arrays(ends, words)})

        for batch in batches:
            kinds = {k: batch.column(k).type for k in keys}
            lists = batch.column("_lv")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            tokens, at = lists.flatten(), 0
            while at < len(lists):
                begin = int(ends[at - 1]) if at else 0
                to = max(int(np.searchsorted(ends, begin + slice_tokens, "right")), at + 1)
                part = tokens.slice(begin, int(ends[to - 1]) - begin).dictionary_encode()
                code = pc.fill_null(pc.index_in(part.dictionary, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                new = code < 0
                code[new] = len(words) + np.arange(new.sum())
                words = pa.concat_arrays([words, part.dictionary.filter(pa.array(new))])
                there = part.indices.is_valid()
                sentence = np.repeat(np.arange(to - at), np.diff(ends[at:to], prepend=begin))[there.to_numpy(zero_copy_only=False)]
                width = max(len(words), 1)
                cell = np.sort(sentence * width + code[part.indices.filter(there).to_numpy(zero_copy_only=False)])
                start = np.flatnonzero(np.diff(cell, prepend=-1))
                count = np.diff(start, append=len(cell))
                sentence, code = np.divmod(cell[start], width)
                per = np.bincount(sentence, minlength=to - at)
                kept = per > 0
                if kept.any():
                    step = np.diff(code, prepend=0)
                    head = (np.cumsum(per) - per)[kept]
                    step[head] = code[head]
                    more = np.bincount(sentence[count > 1], minlength=to - at)
                    yield rows(int(kept.sum()), {k: batch.column(k).slice(at, to - at).filter(pa.array(kept)) for k in keys} | {
                        "_codes": packed(step * 2 + (count > 1), per[kept]), "_counts": packed(count[count > 1], more[kept])})
                at, cells = to, cells + len(code)
                if cells >= most_cells or len(words) >= most_words:
                    yield dictionary()
                    group, cells, words = group + 1, 0, words.slice(0, 0)
        if len(words):
            yield dictionary()

    return run


def placer(keys: Sequence[str]) -> Callable:
    """The sentences of a group and its words' places (``_code, idx``) -> keys, ``indices``, ``counts``.

    Cells of words that have no place are left out, and so are sentences without any other.
    """
    keys, (_, unpacked) = list(keys), _packing()

    def run(sentences, words):
        import numpy as np
        import pyarrow as pa

        step, per = unpacked(sentences.column("_codes"))
        more = step & 1 == 1
        count = np.ones(len(step), np.int64)
        count[more] = unpacked(sentences.column("_counts"))[0]
        # sums of steps over all sentences, less what they are where the cell's own begins
        total = np.append(0, np.cumsum(step >> 1))
        code = total[1:] - np.repeat(total[np.cumsum(per) - per], per)
        known = words.column("_code").to_numpy()
        place = np.full(max(code.max(initial=0), known.max(initial=0)) + 1, -1)
        place[known] = words.column("idx").to_numpy()
        idx, sentence = place[code], np.repeat(np.arange(len(per)), per)
        there, width = idx >= 0, int(place.max()) + 1 or 1
        cell = sentence[there] * width + idx[there]
        order = np.argsort(cell)
        sentence, idx = np.divmod(cell[order], width)
        per = np.bincount(sentence, minlength=len(per))
        ends = pa.array(np.append(0, np.cumsum(per[per > 0])).astype(np.int32))
        out = sentences.select(keys).filter(pa.array(per > 0))
        return (out.append_column("indices", pa.ListArray.from_arrays(ends, pa.array(idx)))
                .append_column("counts", pa.ListArray.from_arrays(ends, pa.array(count[there][order]))))

    return run

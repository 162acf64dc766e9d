"""Repeated byte strings over all documents, by suffix arrays of shards.

A byte goes if it lies in a ``LENGTH``-byte string of its document that also
starts earlier (smaller doc_id, or the same document, earlier start).

1. Anchors. Of the ``GRAM``-byte grams inside a window of ``LENGTH`` bytes the one
   of least hash (leftmost) is the window's anchor; equal windows have equal
   anchors at equal offsets. The windows of one anchor follow each other: they
   make up a snippet of ``LENGTH`` to ``2 * LENGTH - GRAM`` bytes. So any repeat is
   found among the snippets of one gram, and every window is in one snippet.
2. Equal snippets (gram, 64-bit digest) are combined, in each batch before the
   shuffle and by gram after it: the earliest stays, the others are repeats as a
   whole. Thousands of copies of a text thus shrink to one.
3. Grams with several different snippets go to shards with the snippets' bytes.
   A shard of about ``SHARD_BYTES`` gets a suffix array by Larsson-Sadakane
   refinement (only unsorted groups are sorted again, with doubled depth) and
   common prefixes by Kasai's rule, run in lanes over the text. Runs of suffixes
   that share ``LENGTH`` bytes are one string; its earliest occurrence stays.
   Snippets of a gram that fill several shards are merged: the distinct windows
   of a shard, in suffix order, are looked up in those before by binary search.
4. Removed intervals meet their texts once more and are cut out.

Texts move compressed. Buckets are by gram hash, so shards of any corpus size
stay as small as the number of shuffle partitions makes them.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes are kept whole;
rows without id come last; rows that share an id are ordered by text hash, and
rows equal in id and text are one document, judged alike; an empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K
from emberlog.llm.tables import shuffle_parts
from emberlog.session import materialize

LENGTH, GRAM, SHARD_BYTES = 100, 32, 1 << 18
PIECE, RUN_BYTES, ASKED_ROWS = 1 << 20, 8 << 20, 1 << 16
LAST = (1 << 63) - 1  # stands for a missing id
FIELDS = (("gram", np.uint64), ("digest", np.uint64), ("doc", np.int64), ("tie", np.int32), ("at", np.uint32), ("size", np.uint8))


def _zstd():
    """Imported in the tasks only: all other queries do without it."""
    import zstandard

    return zstandard


def _rolled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM bytes and of the 64 bytes from each position."""
    h, width, power = data.astype(np.uint64) + np.uint64(1), 1, int(K.STEP)
    gram = None
    while width < 64:
        if width == GRAM:
            gram = h
        h = h[:-width] * np.uint64(power) + h[width:] if len(h) > width else h[:0]
        width, power = 2 * width, power * power & 0xFFFFFFFFFFFFFFFF
    return K.mix(gram), h


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum over ``width`` entries from each position."""
    have, out = 1, key
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def snippets(data: np.ndarray, at: np.ndarray):
    """Snippets of the rows of a piece: (row, start in the row, size, gram hash, digest)."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    gram, wide = _rolled(data)
    key = ((gram >> np.uint64(32)) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
    least = (_least(key, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    room = np.maximum(np.diff(at) - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(room)), room)
    start = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + np.repeat(at[:-1], room)
    if not len(start):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    anchor = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(start)) - 1
    a, first, end = anchor[lo], start[lo], start[hi] + LENGTH
    digest = (a - first).astype(np.uint64)
    for place in (first, first + LENGTH - 64, end - LENGTH, end - 64):  # four 64-byte pieces cover a snippet
        digest = K.mix(digest * K.STEP + wide[place])
    return row[lo], first - at[row[lo]], end - first, gram[a], digest + (end - first).astype(np.uint64) * K.GOLDEN


def _pack(fields: list[np.ndarray]) -> bytes:
    fields = list(fields)
    fields[2] = np.diff(fields[2], prepend=np.int64(0))
    raw = len(fields[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(f).tobytes() for f in fields)
    return _zstd().ZstdCompressor(1).compress(raw)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = _zstd().ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for _, kind in FIELDS:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    out[2] = np.cumsum(out[2])
    return out


def _runs(batches):
    """The batches in tables of about RUN_BYTES of text."""
    for batch in batches:
        _, at = K.text_bytes(batch.column("text"))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + RUN_BYTES, "right")) - 1)
            yield pa.Table.from_batches([batch.slice(lo, hi - lo)])
            lo = hi


def _anchor_rows(batches, buckets: int):
    """Blobs of snippets by gram bucket; of equal snippets of a run of rows only the earliest, the others as removed."""
    for table in _runs(batches):
        table = table.sort_by([("doc", "ascending"), ("tie", "ascending")]).combine_chunks()
        doc, tie = table.column("doc").to_numpy(), table.column("tie").to_numpy()
        same = np.concatenate([[False], (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1])])  # rows equal in id and text
        data, offs = K.text_bytes(table.column("text"))
        parts = []
        for lo, hi, part, at in K.pieces(data, offs, PIECE):
            row, start, size, gram, digest = snippets(part, at)
            row = row + lo
            once = ~same[row]
            parts.append([gram[once], digest[once], doc[row][once], tie[row][once], start[once].astype(np.uint32), size[once].astype(np.uint8)])
        if not parts:
            continue
        fields = [np.concatenate(c) for c in zip(*parts)]
        if not len(fields[0]):
            continue
        whole = K.mix(fields[0] ^ (fields[1] * K.STEP))
        order = np.argsort(whole, kind="stable")
        again = np.zeros(len(order), bool)
        again[order[1:]] = whole[order[1:]] == whole[order[:-1]]
        bucket = (fields[0] % np.uint64(buckets)).astype(np.int64)
        # what a batch settles itself only passes through a bucket, any bucket
        bucket = np.where(again, -1 - (fields[1] % np.uint64(buckets)).astype(np.int64), bucket)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for run in np.split(order, cuts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[run[0]] if bucket[run[0]] >= 0 else -1 - bucket[run[0]]], pa.int32()), pa.array([bool(bucket[run[0]] < 0)]),
                 pa.array([_pack([f[run] for f in fields])], pa.binary())], ["bucket", "settled", "blob"])


VERDICT = "bucket int, doc long, tie int, at long, size int, gram long, ask boolean"


def _verdict_batch(bucket: int, fields, ask: bool) -> pa.RecordBatch:
    gram, _, doc, tie, at, size = fields
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, bucket, np.int32)), pa.array(doc), pa.array(tie), pa.array(at.astype(np.int64)), pa.array(size.astype(np.int32)),
         K.signed(gram), pa.array(np.full(n, ask))], [c.split()[0] for c in VERDICT.split(", ")])


def _bucket_verdicts(batches):
    """Per bucket: equal snippets but the earliest are removed; those left of a gram with several are asked for."""
    now, held = None, []

    def close():
        if not held:
            return
        fields = [np.concatenate(c) for c in zip(*held)]
        gram, digest, doc, tie, at, _ = fields
        order = np.lexsort((at, tie, doc, digest, gram))
        fields = [f[order] for f in fields]
        gram, digest, doc, tie, at, _ = fields
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new = new_gram | np.concatenate([[True], digest[1:] != digest[:-1]])
        twin = ~new & np.concatenate([[False], (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1]) & (at[1:] == at[:-1])])
        if (~new & ~twin).any():
            yield _verdict_batch(now, [f[~new & ~twin] for f in fields], False)
        kinds = np.bincount(np.cumsum(new_gram) - 1, weights=new)[np.cumsum(new_gram) - 1]
        ask = new & (kinds > 1)
        if ask.any():
            yield _verdict_batch(now, [f[ask] for f in fields], True)

    for batch in batches:
        for bucket, settled, blob in zip(batch.column("bucket").to_pylist(), batch.column("settled").to_pylist(), batch.column("blob").to_pylist()):
            if bucket != now:
                yield from close()
                now, held = bucket, []
            fields = _unpack(blob)
            if settled:
                yield _verdict_batch(bucket, fields, False)
            else:
                held.append(fields)
    yield from close()


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros past the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = padded[: len(data)].astype(np.uint64)
    for i in range(1, 8):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in order of their suffixes (Larsson-Sadakane refinement)."""
    n = len(data)
    first = words_at(data)
    order = np.argsort(first, kind="stable")
    value = first[order]
    head = np.concatenate([[True], value[1:] != value[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while True:
        tail = np.append(head[1:], True)
        open_ = np.flatnonzero(~(head & tail))  # suffixes that share a group
        if not len(open_):
            break
        suffix = order[open_]
        key = (rank[suffix] << 32) + rank[np.minimum(suffix + h, n)] + 1
        turn = np.argsort(key, kind="stable")
        order[open_] = suffix[turn]
        key = key[turn]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        head[open_] = fresh
        rank[order[open_]] = np.maximum.accumulate(np.where(fresh, open_, 0))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int = LENGTH, lane: int = 64) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``most`` bytes.

    Kasai's rule: going through the text, the common prefix shrinks by one at
    most from a position to the next. Lanes of ``lane`` positions go through
    their part of the text side by side.
    """
    n = len(data)
    before = np.full(n, n, np.int64)
    before[order[1:]] = order[:-1]
    words = np.append(words_at(data), np.uint64(0))
    out = np.zeros(n, np.int64)
    start = np.arange(0, n, lane)
    have = np.zeros(len(start), np.int64)
    for i in range(lane):
        p = start + i
        live = p < n
        p = p[live]
        q = before[p]
        size = np.where(q < n, np.maximum(have[live] - 1, 0), 0)
        grow = np.flatnonzero(q < n)
        while len(grow):
            a, b = p[grow] + size[grow], q[grow] + size[grow]
            far = np.maximum(a, b)
            differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            bits = np.frexp((differ >> np.uint64(11)).astype(np.float64))[1] + 11  # position of the highest set bit
            bits = np.where(differ >> np.uint64(11), bits, np.frexp(differ.astype(np.float64))[1])
            same = np.minimum(np.where(differ == 0, 8, (64 - bits) // 8), np.maximum(n - far, 0))
            size[grow] = np.minimum(size[grow] + same, most)
            grow = grow[(same == 8) & (size[grow] < most)]
        out[p] = size
        have[live] = size
    return out[order]


def _window_words(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows as rows of big-endian words, which compare like their bytes."""
    words = np.concatenate([words_at(data), np.zeros(LENGTH, np.uint64)])
    cols = [words[start + 8 * i] for i in range(LENGTH // 8)]
    rest = LENGTH % 8
    if rest:
        cols.append(words[start + LENGTH - rest] >> np.uint64(64 - 8 * rest))
    return np.stack(cols, axis=1)


def _found(table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of rows in a sorted table of rows: (place, whether it is there)."""
    if len(asked) > ASKED_ROWS:
        parts = [_found(table, asked[k : k + ASKED_ROWS]) for k in range(0, len(asked), ASKED_ROWS)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    lo, hi = np.zeros(len(asked), np.int64), np.full(len(asked), len(table), np.int64)
    while (lo < hi).any():
        mid = np.minimum((lo + hi) // 2, len(table) - 1)
        differ = table[mid] != asked
        col = differ.argmax(1)
        at = np.arange(len(asked))
        less = differ.any(1) & (table[mid, col] < asked[at, col]) & (lo < hi)
        lo, hi = np.where(less, mid + 1, lo), np.where(~less & (lo < hi), mid, hi)
    there = lo < len(table)
    there[there] = (table[lo[there]] == asked[there]).all(1)
    return lo, there


def repeated_windows(shards: list[list[tuple[int, int, int, bytes]]]):
    """Windows that start earlier too, among the snippets ``(doc, tie, at, bytes)`` of some shards.

    Yields ``(doc, tie, start, size)`` of the bytes they cover, by snippet.
    """
    places, numbers, table, table_at = [], [], None, None
    total = 0
    for shard in shards:
        data = np.frombuffer(b"".join(s[3] for s in shard), np.uint8)
        size = np.array([len(s[3]) for s in shard])
        room = size - LENGTH + 1
        first = np.cumsum(size) - size
        snippet = np.repeat(np.arange(len(shard)), room)
        inside = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        start = first[snippet] + inside
        is_window = np.zeros(len(data), bool)
        is_window[start] = True
        order = suffix_array(data)
        string = np.cumsum(common_prefixes(data, order) < LENGTH) - 1  # suffixes of one string share LENGTH bytes
        of = np.empty(len(data), np.int64)
        of[order] = string
        sorted_windows = order[is_window[order]]
        strings, one = np.unique(of[sorted_windows], return_index=True)  # in suffix order
        number = np.searchsorted(strings, of[start])
        if len(shards) > 1:
            distinct = _window_words(data, sorted_windows[one])
            if table is None:
                table, table_at = distinct, np.arange(len(distinct))
                known = table_at
            else:
                at, there = _found(table, distinct)
                known = np.empty(len(distinct), np.int64)
                known[there] = table_at[at[there]]
                known[~there] = total + np.arange((~there).sum())
                table = np.insert(table, at[~there], distinct[~there], axis=0)
                table_at = np.insert(table_at, at[~there], known[~there])
            total = len(table)
            number = known[number]
        places.append((np.array([s[0] for s in shard], np.int64)[snippet], np.array([s[1] for s in shard], np.int64)[snippet],
                       np.array([s[2] for s in shard], np.int64)[snippet] + inside))
        numbers.append(number)
    doc, tie, at = (np.concatenate(c) for c in zip(*places))
    number = np.concatenate(numbers)
    order = np.lexsort((at, tie, doc, number))
    later = np.zeros(len(order), bool)
    later[order[1:]] = number[order[1:]] == number[order[:-1]]
    doc, tie, at = doc[later], tie[later], at[later]
    if not len(doc):
        return
    # windows of a snippet that follow each other make one interval
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1] + 1)])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(at)) - 1
    yield doc[lo], tie[lo], at[lo], at[hi] - at[lo] + LENGTH


def _shard_rows(batches, shard_bytes: int):
    """Suffix arrays over the snippets of a bucket; rows come by bucket and gram, and only a gram can span shards."""
    shards: list[list] = [[]]
    size, last = 0, None

    def close():
        if any(shards):
            for doc, tie, at, n in repeated_windows([s for s in shards if s]):
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tie.astype(np.int32)), pa.array(at), pa.array(n.astype(np.int32))], ["doc", "tie", "at", "size"])

    for batch in batches:
        for gram, doc, tie, at, raw in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc", "tie", "at", "raw"))):
            if size >= shard_bytes:
                if gram != last:
                    yield from close()
                    shards, size = [[]], 0
                else:
                    shards.append([])
                    size = 0
            shards[-1].append((doc, tie, at, raw))
            size += len(raw)
            last = gram
    yield from close()


def _squeezed(batches):
    pack = _zstd().ZstdCompressor(1)
    for batch in batches:
        raw = batch.column("text").cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("tie"), batch.column("doc_id"), pa.array([pack.compress(x.as_buffer()) for x in raw], pa.binary())],
            ["doc", "tie", "doc_id", "z"])


def _lists(column: pa.Array, names: tuple[str, ...]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a column of lists of structs (null: empty)."""
    n = column.value_lengths().fill_null(0).to_numpy()
    inner = column.flatten()
    return np.concatenate([[0], np.cumsum(n)]), {c: inner.field(names.index(c)).to_numpy() for c in names}


def _cut_snippets(batches):
    unpack = _zstd().ZstdDecompressor()
    for batch in batches:
        first, asked = _lists(batch.column("asked"), ("bucket", "gram", "at", "size"))
        doc, tie, packed = batch.column("doc").to_numpy(), batch.column("tie").to_numpy(), batch.column("z")
        lo = 0
        while lo < batch.num_rows:
            raws, held, hi = [], 0, lo
            while hi < batch.num_rows and held < 8 << 20:
                text = unpack.decompress(packed[hi].as_buffer())
                for at, size in zip(asked["at"][first[hi] : first[hi + 1]].tolist(), asked["size"][first[hi] : first[hi + 1]].tolist()):
                    raws.append(text[at : at + size])
                    held += size
                hi += 1
            some, n = slice(first[lo], first[hi]), np.diff(first[lo : hi + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked["bucket"][some]), pa.array(asked["gram"][some]), pa.array(np.repeat(doc[lo:hi], n)), pa.array(np.repeat(tie[lo:hi], n)),
                 pa.array(asked["at"][some]), pa.array(raws, pa.binary())], ["bucket", "gram", "doc", "tie", "at", "raw"])
            lo = hi


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(batches):
    unpack = _zstd().ZstdDecompressor()
    for batch in batches:
        out = []
        first, spans = _lists(batch.column("spans"), ("at", "size"))
        for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            text = unpack.decompress(batch.column("z")[row].as_buffer())
            removed = runs = at = 0
            kept = hashlib.sha256()
            own = slice(first[row], first[row + 1])
            begin = spans["at"][own]
            order = np.argsort(begin, kind="stable")
            for lo, hi in zip(begin[order].tolist(), (begin + spans["size"][own])[order].tolist()):
                if lo > at or not runs:
                    kept.update(text[at:lo])
                    runs += 1
                    at = lo
                if hi > at:
                    removed += hi - at
                    at = hi
            kept.update(text[at:])
            out.append((doc_id, len(text), removed, runs, kept.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], [c.split()[0] for c in CUT.split(", ")])


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                       F.hash(text).alias("tie"), text.alias("text"))


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc, tie, at, size``: byte intervals (overlapping) that are repeats, by document key."""
    rows = _rows(docs)
    parts = shuffle_parts(docs.sparkSession)
    buckets = 4 * parts
    blobs = rows.select("doc", "tie", "text").mapInArrow(lambda b: _anchor_rows(b, buckets), "bucket int, settled boolean, blob binary")
    blobs = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket")
    verdicts = materialize(blobs.mapInArrow(_bucket_verdicts, VERDICT), "verdicts")
    asked = verdicts.where("ask").groupBy("doc", "tie").agg(F.collect_list(F.struct("bucket", "gram", "at", "size")).alias("asked"))
    squeezed = squeezed_texts(docs).dropDuplicates(["doc", "tie"])
    cut = squeezed.join(asked, ["doc", "tie"]).select("doc", "tie", "z", "asked").mapInArrow(
        _cut_snippets, "bucket int, gram long, doc long, tie int, at long, raw binary")
    cut = cut.repartition(parts, "bucket").sortWithinPartitions("bucket", "gram", "doc", "tie", "at")
    partial = cut.mapInArrow(lambda b: _shard_rows(b, shard_bytes), "doc long, tie int, at long, size int")
    return verdicts.where("not ask").select("doc", "tie", "at", "size").unionAll(partial)


def squeezed_texts(docs: DataFrame) -> DataFrame:
    return _rows(docs).mapInArrow(_squeezed, "doc long, tie int, doc_id long, z binary")


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    spans = repeated_spans(docs, shard_bytes).groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "size")).alias("spans"))
    return squeezed_texts(docs).join(spans, ["doc", "tie"], "left").select("doc_id", "z", "spans").mapInArrow(_kept, CUT)

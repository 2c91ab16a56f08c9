"""Removal of passages that an earlier document has, through sorted suffixes.

A byte goes if it lies in a string of ``SIZE`` bytes that also starts in a document with a smaller id. Sorting the
suffixes of every byte would move each byte fifty times over, so suffixes are taken at anchors only: positions whose
``GRAM`` bytes have the smallest hash of some ``SIZE`` bytes around them. A string of ``SIZE`` bytes determines its
anchor, hence equal strings have equal anchors, and no match is lost.

1. Tasks send the anchors' hashes by shuffle partition; a hash that two different texts have is shared, and the
   documents that hold it are told so. Unshared anchors, most of them, go no further.
2. For each shared anchor a document sends the suffix that begins ``REACH`` bytes before it and ends ``SIZE`` after,
   which covers every string with this anchor. Sampled splitters range-partition them by the anchor's leading bytes;
   equal anchors have equal leading bytes, so a bucket's edge never parts two suffixes that match.
3. A bucket sorts its suffixes by multikey sort, word by word among ties; neighbours with the same anchor are
   compared at every offset, and each is told which of its strings a smaller document has.
4. Documents meet these answers and drop the bytes.

Documents with equal texts are settled beforehand: all but the one with the smallest id lose everything, and take no
part in 2 and 3. Only compressed texts and hashes travel; suffixes that are equal in a batch travel once.

* Null text: empty. Texts below ``SIZE`` bytes lose nothing. Null ids: nothing is removed from or because of them.
* Rows that repeat an id do not count as earlier than each other. Empty table: no rows.
* Columns beside the id and the text are passed by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.bytepair import ragged
from ledgerline.llm.common import by_bytes, table, tasks
from ledgerline.llm.word_counts import _pack, _unpack

SIZE, GRAM = 50, 16
REACH = SIZE - GRAM
SPAN = REACH + SIZE
#: Bits of an anchor's hash that travel. Two anchors that agree in them by chance cost a suffix sent in vain.
SHORT = np.uint64((1 << 48) - 1)
#: One document in so many gives the splitters.
SPLITTER_SHARE = 64
BATCH = scan.BLOCK
#: Hashes, and suffixes, that a task compares at a time; larger groups of equal ones are taken whole.
RANGE, NEIGHBOURS = 1 << 19, 1 << 13


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each run of ``width`` neighbours."""
    held = 1
    while held < width:
        step = min(held, width - held)
        values = pick(values[: len(values) - step], values[step:])
        held += step
    return values


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of joined texts; ``at`` are the texts' starts, one byte parts them."""
    n = len(data)
    if n < SIZE:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    sums = scan.prefix(data)
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= scan._powers(scan._INVERSE, len(grams))
    grams = scan.mixed(grams)
    least = _slide(grams, REACH + 1, np.minimum)
    whole = np.zeros(len(least), dtype=bool)
    size = np.diff(at) - 1
    for a, s in zip(at[:-1][size >= SIZE], size[size >= SIZE]):
        whole[a : a + s - SIZE + 1] = True
    least = np.where(whole, least, 0)
    padded = np.zeros(len(least) + 2 * REACH, dtype=np.uint64)
    padded[REACH : REACH + len(least)] = least
    best = _slide(padded, REACH + 1, np.maximum)
    found = np.flatnonzero((grams[: len(best)] == best[: len(grams)]) & (best[: len(grams)] > 0))
    return found, grams[found]


def suffixes(data: np.ndarray, at: np.ndarray, found: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, edges, bytes): of each anchor the bytes around it, how many of them precede and follow it in its text
    (``edges``, two columns; others are zero), and a hash of both."""
    before = np.minimum(found - at[doc], REACH)
    after = np.minimum(at[doc + 1] - 1 - found, SIZE)
    column = np.arange(SPAN) - REACH
    inside = (column >= -before[:, None]) & (column < after[:, None])
    place = np.clip(found[:, None] + column, 0, len(data) - 1)
    held = np.where(inside, data[place], 0).astype(np.uint8)
    edges = np.stack([before, after], axis=1).astype(np.uint8)
    return named(edges, held), edges, held


def named(edges: np.ndarray, held: np.ndarray) -> np.ndarray:
    """A hash of each suffix and its edges."""
    words = np.ascontiguousarray(np.pad(held, ((0, 0), (0, -SPAN % 8)))).view(np.uint64)
    name = (edges[:, 0].astype(np.uint64) << np.uint64(8)) + edges[:, 1]
    for i in range(words.shape[1]):
        name = scan.mixed(name * np.uint64(0x9E3779B97F4A7C15) + words[:, i])
    return name


def sorted_order(rows: np.ndarray) -> np.ndarray:
    """Order of the rows' bytes: by their first eight, then, among ties only, by the next eight, and so on."""
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.append(0, np.cumsum(np.diff(words[order, 0].view(np.int64)) != 0)) if len(order) else order
    for i in range(1, words.shape[1]):
        size = np.bincount(group) if len(group) else group
        tied = np.flatnonzero(size[group] > 1) if len(group) else group
        if not len(tied):
            break
        order[tied] = order[tied][np.lexsort((words[order[tied], i], group[tied]))]
        new = words[order, i]
        split = np.append(False, (group[1:] != group[:-1]) | (new[1:] != new[:-1]) & (size[group[1:]] > 1))
        group = np.cumsum(split)
    return order


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("mark", F.xxhash64("text", F.crc32(F.col("text").cast("binary"))))


def _batches(frames: Iterator[pd.DataFrame]):
    for frame in frames:
        sizes = np.array([len(t) if isinstance(t, str) else 0 for t in frame["text"]], dtype=np.int64)
        for part in by_bytes(sizes, BATCH):
            # Only these texts are held as bytes too; a character may be up to four of them.
            texts = scan.encoded(frame["text"].iloc[part])
            for own in by_bytes(np.array([len(t) for t in texts]), BATCH):
                data, at = scan.joined(texts[own])
                yield frame.iloc[part].iloc[own], data, at


def _asked(rows: DataFrame, parts: int) -> DataFrame:
    """(part, batch, blob): the anchors' hashes of a batch, with their documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, data, at in _batches(frames):
            found, gram = anchors(data, at)
            gram &= SHORT
            doc = np.searchsorted(at, found, side="right") - 1
            part, rest = (gram % np.uint64(parts)).astype(np.int64), gram // np.uint64(parts)
            order = np.lexsort((doc, rest, part))
            part, rest, doc = part[order], rest[order], doc[order]
            new = np.append(True, (part[1:] != part[:-1]) | (rest[1:] != rest[:-1]) | (doc[1:] != doc[:-1]))[: len(part)]
            part, rest, doc = part[new], rest[new], doc[new]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            ids, marks = frame["doc"].to_numpy(np.int64), frame["mark"].to_numpy(np.int64)
            batch, out = _name(ids, marks), []
            for p in np.unique(part):
                own = slice(cuts[p], cuts[p + 1])
                local, short = np.unique(doc[own], return_inverse=True)
                steps = np.diff(rest[own], prepend=np.uint64(0))
                out.append((p, batch, _pack(steps, short.astype(np.uint32), ids[local], marks[local])))
            yield pd.DataFrame(out, columns=["part", "batch", "blob"])

    return rows.mapInPandas(run, "part int, batch long, blob binary")


def _name(ids: np.ndarray, marks: np.ndarray) -> int:
    """A name for a batch of documents."""
    digest = hashlib.blake2b(ids.tobytes() + marks.tobytes(), digest_size=8).digest()
    return int(np.frombuffer(digest, dtype=np.int64)[0])


def _reply(ids: np.ndarray, marks: np.ndarray, doc: np.ndarray, values: np.ndarray) -> bytes:
    """What is to be told to the documents (places in ``ids``), by document; ``values`` has a row for each."""
    order = np.argsort(doc, kind="stable")
    which, size = np.unique(doc[order], return_counts=True)
    return _pack(ids[which], marks[which], size.astype(np.int64), values[order].ravel())


def _per_document(replies: DataFrame, parts: int, wide: int) -> DataFrame:
    """(doc, mark, kind, held): all replies to a document in one row; ``wide`` numbers make one of them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batches: dict[int, list[bytes]] = {}
        for frame in frames:
            for batch, blob in zip(frame["batch"].tolist(), frame["blob"]):
                batches.setdefault(batch, []).append(blob)
        for batch in sorted(batches):
            ids, marks, size, values = (np.concatenate(x) for x in zip(*map(_unpack, batches[batch])))
            order = np.lexsort((marks, ids))
            values = values.reshape(-1, wide)[ragged((np.cumsum(size) - size)[order], size[order])]
            ids, marks, size = ids[order], marks[order], size[order]
            first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]))[: len(ids)])
            total = np.cumsum(size)
            ends = total[np.append(first[1:], len(ids)) - 1] if len(ids) else total
            held = [values[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)]
            yield pd.DataFrame({"doc": ids[first], "mark": marks[first], "kind": 1, "held": held})

    return replies.repartition(parts, "batch").mapInPandas(run, "doc long, mark long, kind int, held binary")


def in_two_texts(hashes: list[np.ndarray], marks: list[tuple[np.ndarray, np.ndarray]], end: int) -> list[np.ndarray]:
    """Whether each hash (below ``end``, in rising order in every list) also belongs to another mark; ``marks`` are a
    list's own and the place of each hash's among them. Hashes are compared range by range, ``RANGE`` about at a time."""
    steps = max(1, -(-sum(map(len, hashes)) // RANGE))
    edges = np.array([end * i // steps for i in range(1, steps)], dtype=np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(h, edges), [len(h)]]) for h in hashes]
    out = [np.zeros(len(h), dtype=bool) for h in hashes]
    for i in range(steps):
        own = [slice(c[i], c[i + 1]) for c in cuts]
        held = np.concatenate([h[at] for h, at in zip(hashes, own)])
        if not len(held):
            continue
        mark = np.concatenate([m[place[at]] for (m, place), at in zip(marks, own)])
        order = np.argsort(held, kind="stable")
        first = np.flatnonzero(np.append(True, held[order[1:]] != held[order[:-1]]))
        mark = mark[order]
        many = np.minimum.reduceat(mark, first) < np.maximum.reduceat(mark, first)
        hit = np.zeros(len(held), dtype=bool)
        hit[order] = np.repeat(many, np.diff(np.append(first, len(held))))
        done = 0
        for flags, at in zip(out, own):
            flags[at] = hit[done : done + at.stop - at.start]
            done += at.stop - at.start
    return out


def _shared(asked: DataFrame, parts: int) -> DataFrame:
    """(batch, blob): for each request the hashes that another text has too, by document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for frame in frames for r in zip(frame["part"], frame["batch"], frame["blob"])]
        for p in sorted({r[0] for r in rows}):
            blobs = [(batch, _unpack(b)) for q, batch, b in rows if q == p]
            rest = [np.cumsum(b[0], dtype=np.uint64) for _, b in blobs]
            hits, out = in_two_texts(rest, [(b[3], b[1]) for _, b in blobs], int(SHORT) // parts + 1), []
            for own, hit, (batch, (_, short, ids, own_marks)) in zip(rest, hits, blobs):
                if hit.any():
                    out.append((batch, _reply(ids, own_marks, short[hit], own[hit] * np.uint64(parts) + np.uint64(p))))
            yield pd.DataFrame(out, columns=["batch", "blob"])

    return asked.repartition(parts, "part").mapInPandas(run, "batch long, blob binary")


def _texts(rows: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=6)
        for frame in frames:
            packed = [press.compress(t) for t in scan.encoded(frame["text"])]
            yield pd.DataFrame({"doc": frame["doc"], "mark": frame["mark"], "kind": 2, "held": packed})

    return rows.mapInPandas(run, "doc long, mark long, kind int, held binary")


def _met(answers: DataFrame, rows: DataFrame, heads: DataFrame, parts: int) -> DataFrame:
    """Answers (kind 1) and texts (kind 2) of each document side by side; kind 0 marks the first of equal texts."""
    first = heads.select("doc", "mark", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("held"))
    both = first.unionByName(answers).unionByName(_texts(rows))
    return both.repartition(parts, "doc", "mark").sortWithinPartitions("doc", "mark", "kind")


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[list[tuple[int, bool, list[bytes], bytes, int]]]:
    """Batches of (doc, whether it is the first of its text, answers, text, mark)."""
    grow = zstandard.ZstdDecompressor()
    now, head, answers, out, held = None, False, [], [], 0
    for frame in frames:
        for doc, mark, kind, value in zip(frame["doc"].tolist(), frame["mark"].tolist(), frame["kind"].tolist(), frame["held"]):
            if (doc, mark) != now:
                now, head, answers = (doc, mark), False, []
            if kind == 0:
                head = True
            elif kind == 1:
                answers.append(value)
            else:
                text = grow.decompress(value)
                out.append((doc, head, answers, text, mark))
                held += len(text)
                if held > BATCH:
                    yield out
                    out, held = [], 0
    if out:
        yield out


def _sent(met: DataFrame, splitters: np.ndarray) -> DataFrame:
    """(bucket, batch, blob): suffixes at shared anchors of the first of equal texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for docs in _documents(frames):
            docs = [d for d in docs if d[1] and d[2]]
            if not docs:
                continue
            data, at = scan.joined([d[3] for d in docs])
            found, gram = anchors(data, at)
            gram &= SHORT
            doc = np.searchsorted(at, found, side="right") - 1
            mine = [np.frombuffer(b"".join(d[2]), dtype=np.uint64) for d in docs]
            owner = np.repeat(np.arange(len(docs)), [len(m) for m in mine]).astype(np.uint64)
            known = np.unique(scan.mixed(np.concatenate(mine)) ^ scan.mixed(owner))
            keep = np.isin(scan.mixed(gram) ^ scan.mixed(doc.astype(np.uint64)), known)
            found, doc = found[keep], doc[keep]
            if not len(found):
                continue
            name, edges, held = suffixes(data, at, found, doc)
            _, one = np.unique(scan.mixed(name) ^ scan.mixed(doc.astype(np.uint64)), return_index=True)
            name, edges, held, doc = name[one], edges[one], held[one], doc[one]
            lead = np.ascontiguousarray(held[:, REACH : REACH + 8]).view(">u8").ravel().astype(np.uint64)
            bucket = np.searchsorted(splitters, lead, side="right")
            ids, marks = (np.array([d[i] for d in docs], dtype=np.int64) for i in (0, 4))
            batch, out = _name(ids, marks), []
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                _, first, back = np.unique(name[own], return_index=True, return_inverse=True)
                # In the order of their bytes, in which they compress best; their names follow from the bytes.
                order = sorted_order(held[own[first]])
                pick, short = own[first[order]], np.argsort(order)[back]
                local, place = np.unique(doc[own], return_inverse=True)
                parts = (edges[pick].ravel(), held[pick].ravel(), short.astype(np.uint32))
                out.append((int(b), batch, _pack(*parts, place.astype(np.uint32), ids[local], marks[local], level=6)))
            yield pd.DataFrame(out, columns=["bucket", "batch", "blob"])

    return met.select("doc", "mark", "kind", "held").mapInPandas(run, "bucket int, batch long, blob binary")


def compared(name: np.ndarray, edges: np.ndarray, held: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset (bytes before the anchor) of the strings of each suffix that a smaller document has.

    ``name`` tells equal suffixes; without such a string the smallest is above the largest.
    """
    low, high = np.full(len(name), SPAN, dtype=np.int64), np.full(len(name), -1, dtype=np.int64)
    if not len(name):
        return low, high
    _, first, back = np.unique(name, return_index=True, return_inverse=True)
    least = np.full(len(first), 2**63 - 1, dtype=np.int64)
    np.minimum.at(least, back, doc)
    later = doc > least[back]
    low[later] = np.maximum(SIZE - edges[later, 1].astype(np.int64), 0)
    high[later] = edges[later, 0]
    # One row of each suffix, that of its smallest document, in suffix order; equal anchors are neighbours.
    order = sorted_order(held[first][:, REACH:])
    grams = held[first][order, REACH : REACH + GRAM]
    group = np.append(0, np.cumsum((grams[1:] != grams[:-1]).any(axis=1)))
    many = np.bincount(group)[group] > 1
    rows, group = order[many], group[many]
    own_low, own_high = np.full(len(first), SPAN, dtype=np.int64), np.full(len(first), -1, dtype=np.int64)
    at = 0
    while at < len(rows):
        end = min(at + NEIGHBOURS, len(rows))
        while end < len(rows) and group[end] == group[end - 1]:
            end += 1
        part, g = rows[at:end], group[at:end].astype(np.uint64)
        bytes_, edge, who = held[first[part]], edges[first[part]].astype(np.int64), least[part]
        sums = np.zeros((len(part), SPAN + 1), dtype=np.uint64)
        np.cumsum(scan._BYTE[bytes_] * scan._powers(scan._BASE, SPAN), axis=1, out=sums[:, 1:], dtype=np.uint64)
        inverse = scan._powers(scan._INVERSE, SPAN)
        for offset in range(REACH + 1):
            fit = np.flatnonzero((edge[:, 0] >= offset) & (edge[:, 1] >= SIZE - offset))
            a = REACH - offset
            string = scan.mixed((sums[fit, a + SIZE] - sums[fit, a]) * inverse[a] + scan.mixed(g[fit]))
            sort = np.lexsort((who[fit], string))
            head = np.append(True, string[sort][1:] != string[sort][:-1])[: len(sort)]
            smallest = who[fit][sort][np.maximum.accumulate(np.where(head, np.arange(len(sort)), 0))]
            hit = part[fit[sort[smallest < who[fit][sort]]]]
            own_low[hit] = np.minimum(own_low[hit], offset)
            own_high[hit] = np.maximum(own_high[hit], offset)
        at = end
    low, high = np.where(later, low, own_low[back]), np.where(later, high, own_high[back])
    return low, high


def _found(sent: DataFrame, parts: int) -> DataFrame:
    """(batch, blob): for each request the names of suffixes with the offsets of their repeated strings, by document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for frame in frames for r in zip(frame["bucket"], frame["batch"], frame["blob"])]
        for p in sorted({r[0] for r in rows}):
            names, edges, held, docs, back = [], [], [], [], []
            for batch, blob in ((batch, _unpack(b)) for q, batch, b in rows if q == p):
                own_edges, own_held, short, place, ids, marks = blob
                own_edges, own_held = own_edges.reshape(-1, 2), own_held.reshape(-1, SPAN)
                names.append(named(own_edges, own_held)[short])
                edges.append(own_edges[short])
                held.append(own_held[short])
                docs.append(ids[place])
                back.append((batch, place, ids, marks))
            name = np.concatenate(names)
            low, high = compared(name, np.concatenate(edges), np.concatenate(held), np.concatenate(docs))
            record, at, out = np.stack([name, (low << 8 | np.maximum(high, 0)).astype(np.uint64)], axis=1), 0, []
            for batch, place, ids, marks in back:
                own = slice(at, at + len(place))
                at += len(place)
                hit = low[own] <= high[own]
                if hit.any():
                    out.append((batch, _reply(ids, marks, place[hit], record[own][hit])))
            yield pd.DataFrame(out, columns=["batch", "blob"])

    return sent.repartition(parts, "bucket").mapInPandas(run, "batch long, blob binary")


def spans(text_rows: list[tuple[int, bool, list[bytes], bytes, int]]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(doc, text, whether each byte goes) of each document."""
    data, at = scan.joined([d[3] for d in text_rows])
    asked = [i for i, d in enumerate(text_rows) if d[2]]
    change = np.zeros(len(data) + 1, dtype=np.int32)
    if asked:
        found, _ = anchors(data, at)
        doc = np.searchsorted(at, found, side="right") - 1
        some = np.zeros(len(text_rows), dtype=bool)
        some[asked] = True
        found, doc = found[some[doc]], doc[some[doc]]
        records = [np.frombuffer(b"".join(text_rows[i][2]), dtype=np.uint64).reshape(-1, 2) for i in asked]
        owner = scan.mixed(np.repeat(asked, [len(r) for r in records]).astype(np.uint64))
        record = np.concatenate(records)
        keys = scan.mixed(record[:, 0]) ^ owner
        order = np.argsort(keys)
        keys, offsets = keys[order], record[order, 1].astype(np.int64)
        for a in range(0, len(found), 1 << 16):
            f, d = found[a : a + (1 << 16)], doc[a : a + (1 << 16)]
            name, _, _ = suffixes(data, at, f, d)
            want = scan.mixed(name) ^ scan.mixed(d.astype(np.uint64))
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = keys[place] == want
            low, high = offsets[place[hit]] >> 8, offsets[place[hit]] & 255
            np.add.at(change, f[hit] - high, 1)
            np.add.at(change, f[hit] - low + SIZE, -1)
    gone = np.cumsum(change[:-1]) > 0
    for i, (doc_id, head, _, text, _) in enumerate(text_rows):
        own = gone[at[i] : at[i] + len(text)]
        if not head and len(text) >= SIZE:
            own = np.ones(len(text), dtype=bool)
        yield doc_id, text, own


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), or with the kept ``text``, of every row.

    Where a cut falls inside a character, what is left of it is dropped from ``text``; the digest is of the bytes.
    """
    spark = docs.sparkSession
    parts = tasks(spark)
    every = _rows(docs, key, text)
    rows = every.where("doc is not null")
    heads = rows.groupBy("mark").agg(F.min("doc").alias("doc")).select("doc", "mark")
    chosen = rows.where(F.pmod(F.xxhash64("doc"), F.lit(SPLITTER_SHARE)) == 0)

    def leads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, data, at in _batches(frames):
            found, _ = anchors(data, at)
            place = np.minimum(found[:, None] + np.arange(8), len(data) - 1)
            lead = np.ascontiguousarray(data[place]).view(">u8").ravel().astype(np.uint64) >> np.uint64(1)
            yield pd.DataFrame({"lead": lead.astype(np.int64)})

    shares = [i / parts for i in range(1, parts)]
    got = chosen.mapInPandas(leads, "lead long").agg(F.percentile_approx("lead", shares, 10_000)).first()[0] if shares else []
    splitters = np.unique(np.array(got or [], dtype=np.uint64)) << np.uint64(1)
    shared = _per_document(_shared(_asked(rows, parts), parts), parts, 1)
    told = _per_document(_found(_sent(_met(shared, rows, heads, parts), splitters), parts), parts, 2)

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _documents(frames):
            out = []
            for doc, body, gone in spans(group):
                raw = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()
                edge = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                digest = hashlib.sha256(raw).hexdigest()
                out.append((doc, len(body), int(gone.sum()), edge, digest, raw.decode("utf-8", "ignore") if with_text else None))
            yield pd.DataFrame(out, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    done = _met(told, rows, heads, parts).mapInPandas(finish, schema)
    plain = every.where("doc is null").select(
        "doc",
        F.length(F.col("text").cast("binary")).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        "text",
    )
    done = done.unionByName(plain).withColumnRenamed("doc", key)
    return done if with_text else done.drop("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(table(spark, sf_dir, "documents"))

"""Suffix-array removal of strings that an earlier document holds as well.

``without_repeats`` removes from each text, taken as UTF-8 bytes, every byte
that a string of ``LENGTH`` bytes covers which also starts in a document with a
smaller doc_id. Matches never cross documents.

* Sparse suffixes. Of the grams of ``TOKEN`` bytes within a string of
  ``LENGTH``, the one with the least hash (the first of equals) is the
  string's anchor: equal strings have equal anchors at equal places. A text's
  anchors are the suffixes that are sorted, about one for 22 bytes. Each takes
  along the bytes of all strings that it anchors: at most ``LENGTH`` from the
  anchor on and ``BEFORE`` before it.
* Before the shuffle, equal suffixes of a group of texts become one; only the
  smallest doc_id's occurrences travel, as all others are known to go.
* Sampled splitters range-partition the suffixes by their leading token. All
  strings with one anchor have one leading token, so no match lies across a
  splitter. A token that holds more than one splitter is hot: its strings are
  parted by where the anchor lies in them into two classes, each of which
  shares about 30 bytes, and dealt by the hash of these; and if those are hot
  as well, string by string, by the hash of the whole string.
* A bucket sorts its suffixes by multikey quicksort, eight bytes at a time,
  going on only within ties; equal neighbours become one. What neighbours have
  in common, to the right and (sorted again by the bytes before the anchor) to
  the left, tells which strings can occur in two different suffixes; only
  these are compared, byte by byte.
* Removed stretches return, in packed form, to the groups of texts that the
  suffixes came from; texts move once, to be joined with them.

Null texts count as empty. Rows without a doc_id lose nothing and cost others
nothing. Rows that share a doc_id are answered each by its own text, and none
of them makes another lose bytes. Empty tables give no rows. Other columns
play no part. What is left may end within a character, so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import mix, pieces, seeds, text_bytes

LENGTH, TOKEN = 50, 8
BEFORE = LENGTH - TOKEN
#: Bytes of a suffix as it travels: before the anchor, from it on, least and greatest place of the anchor in its strings, two spare.
_WIDTH = 96
#: Strings whose anchor lies up to here are the first class of a hot token.
_PART = 21
#: Windows that are placed at a time, bytes of text that a map task packs together, and that a bucket gets.
WINDOWS, GROUP, BUCKET = 1 << 19, 8 << 20, 8 << 20
#: One of so many regions of ``_REGION`` bytes is sampled, and of its suffixes one of so many.
REGIONS, SUFFIXES, _REGION = 128, 64, 4096


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, first window, last window) of all anchors of the texts; places count over all of ``data``."""
    sizes = np.diff(offsets)
    found = []
    rows = np.flatnonzero(sizes >= LENGTH)
    valid = np.zeros(len(data) + 1, np.int8)  # windows that lie within a row
    valid[offsets[rows]] += 1
    np.add.at(valid, offsets[rows + 1] - LENGTH + 1, -1)
    valid = np.cumsum(valid, dtype=np.int8).astype(bool)
    for at in range(0, max(0, len(data) - LENGTH + 1), WINDOWS):
        end = min(at + WINDOWS, len(data) - LENGTH + 1)
        part = data[at : end + LENGTH - 1]
        grams = np.ndarray(len(part) - TOKEN + 1, ">u8", part, 0, (1,)).astype(np.uint64)
        least = mix(grams) >> np.uint64(20) << np.uint64(20) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= BEFORE + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: end - at], least[BEFORE + 1 - span :][: end - at])
        window = np.flatnonzero(valid[at:end])
        found.append((window + at, (least[window] & np.uint64((1 << 20) - 1)).astype(np.int64) + at))
    window, anchor = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
    if not len(window):
        return (np.empty(0, np.int64),) * 4
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    opened = np.flatnonzero(new)
    closed = np.append(opened[1:], len(window)) - 1
    return np.searchsorted(offsets, window[opened], "right") - 1, anchor[opened], window[opened], window[closed]


def masked(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``rows`` with places of the anchor from ``low`` to ``high``, bytes beyond their strings set to zero."""
    place = np.arange(_WIDTH, dtype=np.int16)[None, :]
    rows *= (place >= (BEFORE - high)[:, None].astype(np.int16)) & (place < (BEFORE + LENGTH - low)[:, None].astype(np.int16))
    rows[:, BEFORE + LENGTH], rows[:, BEFORE + LENGTH + 1] = low, high
    return rows


def suffix_rows(data: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    padded = np.concatenate((np.zeros(BEFORE, np.uint8), data, np.zeros(_WIDTH, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, _WIDTH)[anchor]
    return masked(rows, anchor - last, anchor - first)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes, whose width is a multiple of eight."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    out = np.zeros(len(words), np.uint64)
    for k, seed in enumerate(seeds(words.shape[1], 131)):
        out += mix(words[:, k] * seed + np.uint64(k + 1))
    return mix(out)


def same_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a representative of each kind of row, each row's kind): by hashes, held against the bytes themselves."""
    _, first, kind = np.unique(row_hashes(rows), return_index=True, return_inverse=True)
    for at in range(0, len(rows), 1 << 16):
        if not np.array_equal(rows[at : at + (1 << 16)], rows[first[kind[at : at + (1 << 16)]]]):
            _, first, kind = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
            break
    return first, kind


class Occurrences:
    """Where suffixes occur: row of the suffix, doc_id, number of the text, place of the anchor."""

    FIELDS = ("kind", "doc", "text", "at")

    def __init__(self, kind, doc, text, at):
        self.kind, self.doc, self.text, self.at = kind, doc, text, at

    def __getitem__(self, which) -> Occurrences:
        return Occurrences(*(getattr(self, f)[which] for f in self.FIELDS))

    @staticmethod
    def joined(parts: list) -> Occurrences:
        return Occurrences(*(np.concatenate([getattr(p, f) for p in parts]) for f in Occurrences.FIELDS))


def _covered(rows: np.ndarray, own: Occurrences) -> np.ndarray:
    """(text, start, end) of what all strings of occurrences cover."""
    low, high = (rows[own.kind, BEFORE + LENGTH + k].astype(np.int64) for k in (0, 1))
    return np.stack((own.text, own.at - high, own.at + LENGTH - low), 1)


def combined(rows: np.ndarray, own: Occurrences) -> tuple[np.ndarray, Occurrences, np.ndarray]:
    """Equal suffixes as one with the occurrences in its smallest document, and what larger documents lose by that."""
    first, kind = same_rows(rows)
    own = Occurrences(kind[own.kind], own.doc, own.text, own.at)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, own.kind, own.doc)
    stays = own.doc == least[own.kind]
    rows = rows[first]
    lost = _covered(rows, own[~stays])
    own = own[stays]
    return rows, own, lost


def _limited(rows: np.ndarray, own: Occurrences, low: int, high: int) -> tuple[np.ndarray, Occurrences]:
    """What of suffixes has the anchor at places ``low`` to ``high`` of its strings."""
    a = np.maximum(rows[:, BEFORE + LENGTH].astype(np.int64), low)
    b = np.minimum(rows[:, BEFORE + LENGTH + 1].astype(np.int64), high)
    keep = a <= b
    number = np.cumsum(keep) - 1
    own = own[keep[own.kind]]
    return masked(rows[keep].copy(), a[keep], b[keep]), Occurrences(number[own.kind], own.doc, own.text, own.at)


def leading(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows[:, BEFORE : BEFORE + TOKEN]).view(">u8").ravel().astype(np.uint64)


def class_keys(rows: np.ndarray, later: bool) -> np.ndarray:
    """Hashes of the bytes that all strings of a class share."""
    shared = np.zeros((len(rows), 32), np.uint8)
    core = rows[:, BEFORE - _PART - 1 : BEFORE + TOKEN] if later else rows[:, BEFORE : BEFORE + LENGTH - _PART]
    shared[:, : core.shape[1]] = core
    return row_hashes(shared) ^ np.uint64(later)


class Routes:
    """Splitters of leading tokens, and what is hot."""

    def __init__(self, buckets: int, sample: pa.Table | None = None):
        self.buckets = buckets
        none = np.empty(0, np.uint64)
        self.splitters = self.hot = self.hot_class = none
        if sample is None or not sample.num_rows:
            return
        token, early, late = (sample.column(c).to_numpy().view(np.uint64) for c in ("token", "early", "late"))
        ordered = np.sort(token)
        value, times = np.unique(ordered[(np.arange(1, buckets) * len(ordered)) // buckets], return_counts=True)
        self.splitters, self.hot = value, value[times > 1]
        among = np.isin(token, self.hot)
        for keys in (early[among], late[among]):
            value, times = np.unique(keys, return_counts=True)
            self.hot_class = np.union1d(self.hot_class, value[times * buckets > len(token)])

    def dealt(self, rows: np.ndarray, own: Occurrences) -> Iterator[tuple[np.ndarray, Occurrences, np.ndarray]]:
        """Suffixes with the buckets they go to."""
        token = leading(rows)
        hot = np.isin(token, self.hot)
        to = np.searchsorted(self.splitters, token, "right")
        if not hot.any():
            yield rows, own, to
            return
        yield *_some(rows, own, ~hot), to[~hot]
        rows, own = _some(rows, own, hot)
        for later, (low, high) in enumerate(((0, _PART), (_PART + 1, BEFORE))):
            part, whose = _limited(rows, own, low, high)
            keys = class_keys(part, bool(later))
            hot = np.isin(keys, self.hot_class)
            yield *_some(part, whose, ~hot), (keys[~hot] % np.uint64(self.buckets)).astype(np.int64)
            part, whose = _some(part, whose, hot)
            for place in range(low, high + 1) if len(part) else ():
                string, of = _limited(part, whose, place, place)
                yield string, of, (row_hashes(string) % np.uint64(self.buckets)).astype(np.int64)


def _some(rows: np.ndarray, own: Occurrences, keep: np.ndarray) -> tuple[np.ndarray, Occurrences]:
    number = np.cumsum(keep) - 1
    own = own[keep[own.kind]]
    return rows[keep], Occurrences(number[own.kind], own.doc, own.text, own.at)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; whole numbers byte plane by byte plane, as their high bytes are mostly alike."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    planes = (a if a.itemsize == 1 else np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T for a in arrays)
    return zstandard.ZstdCompressor(level=4).compress(head.tobytes() + b"".join(p.tobytes() for p in planes))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, int(np.frombuffer(raw, np.int64, 1)[0]), 8)
    at, out = 8 * (1 + len(sizes)), []
    for size, kind in zip(sizes, kinds, strict=True):
        part, width = np.frombuffer(raw, np.uint8, int(size), at), np.dtype(kind).itemsize
        out.append(part if width == 1 else np.ascontiguousarray(part.reshape(width, -1).T).view(kind).ravel())
        at += int(size)
    return out


def _packed_suffixes(rows: np.ndarray, own: Occurrences) -> bytes:
    """Suffixes and their occurrences, which come in the suffixes' order; numbers as differences."""
    texts, of = np.unique(own.text, return_inverse=True)
    docs = np.zeros(len(texts), np.int64)
    docs[of] = own.doc
    step = lambda x: np.diff(x, prepend=0)
    return _pack(rows, step(texts), step(docs), np.bincount(own.kind, minlength=len(rows)), step(of.ravel()), step(own.at))


def _unpacked_suffixes(blob: bytes) -> tuple[np.ndarray, Occurrences]:
    rows, texts, docs, times, of, at = _unpack(blob, np.uint8, *[np.int64] * 5)
    of = np.cumsum(of)
    return rows.reshape(-1, _WIDTH), Occurrences(np.repeat(np.arange(len(times)), times), np.cumsum(docs)[of], np.cumsum(texts)[of], np.cumsum(at))


def _answer(columns: dict[str, str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, kind in enumerate(columns.values())], list(columns))


#: What travels: suffixes for a bucket, or stretches that are known to go, or the texts of a group, which the bucket hands on.
_DEALT = {"bucket": "long", "group": "long", "suffixes": "binary", "lost": "binary", "texts": "binary"}
_LOST = {"group": "long", "lost": "binary", "texts": "binary"}


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Pieces of texts, about ``GROUP`` bytes together."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch, "text"):
            held.append(piece)
            size += int(text_bytes(piece.column("text"))[1][-1])
            if size >= GROUP:
                yield held
                held, size = [], 0
    if held:
        yield held


def _emitted(routes: Routes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            # texts of the group by number; what repeats under one id is one text
            both = np.stack([np.concatenate([p.column(c).to_numpy() for p in group]) for c in ("doc_id", "key")], 1)
            texts, number = np.unique(both, axis=0, return_inverse=True)
            number = number.ravel()
            name = int(row_hashes(row_hashes(texts.view(np.uint8).reshape(len(texts), 16))[None, :].view(np.uint8))[0].view(np.int64))
            rows, own, lost, count, base = [], [], [], 0, 0
            for piece in group:
                data, offsets = text_bytes(piece.column("text"))
                row, anchor, first, last = anchors(data, offsets)
                text = number[base + row]
                base += piece.num_rows
                kinds, whose, gone = combined(suffix_rows(data, anchor, first, last), Occurrences(np.arange(len(anchor)), texts[text, 0], text, anchor - offsets[row]))
                whose.kind = whose.kind + count
                count += len(kinds)
                rows.append(kinds)
                own.append(whose)
                lost.append(gone)
            group.clear()
            kinds, whose = np.concatenate(rows), Occurrences.joined(own)
            rows.clear()
            kinds, whose, gone = combined(kinds, whose)
            lost.append(gone)
            out = []
            for part, of, to in routes.dealt(kinds, whose):
                if not len(part):
                    continue
                # by bucket, then as in the texts, so that neighbours are alike and numbers ascend
                of = of[np.lexsort((of.at, of.text, to[of.kind]))]
                _, first, kind = np.unique(of.kind, return_index=True, return_inverse=True)
                order = np.argsort(first, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                shown = of.kind[first[order]]  # suffixes in that order
                of.kind = rank[kind.ravel()]
                of = of[np.argsort(of.kind, kind="stable")]
                bucket = to[shown]
                begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                ends = np.append(begin[1:], len(bucket))
                for a, b, low, high in zip(begin, ends, np.searchsorted(of.kind, begin), np.searchsorted(of.kind, ends), strict=True):
                    mine = of[low:high]
                    mine.kind = mine.kind - a
                    out.append((int(bucket[a]), name, _packed_suffixes(part[shown[a:b]], mine), None, None))
            # texts and what is known to go travel on through any bucket
            lost = merged(np.concatenate(lost))
            out.append((name % routes.buckets, name, None, _pack(lost) if len(lost) else None, _pack(texts)))
            yield _answer(_DEALT, out)

    return run


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            number = -(-np.diff(offsets) // _REGION)
            row = np.repeat(np.arange(piece.num_rows), number)
            region = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            chance = mix(piece.column("key").to_numpy()[row].view(np.uint64) + region.astype(np.uint64) * seeds(1, 151)[0])
            chosen = np.flatnonzero(chance % np.uint64(REGIONS) == 0)
            if not len(chosen):
                continue
            start = offsets[row[chosen]] + region[chosen] * _REGION
            end = np.minimum(start + _REGION, offsets[row[chosen] + 1])
            some = np.concatenate([data[a:b] for a, b in zip(start, end, strict=True)])
            _, anchor, first, last = anchors(some, np.concatenate(([0], np.cumsum(end - start))))
            pick = mix(anchor.astype(np.uint64) ^ chance[chosen[0]]) % np.uint64(SUFFIXES) == 0
            rows = suffix_rows(some, anchor[pick], first[pick], last[pick])
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (leading(rows), class_keys(rows, False), class_keys(rows, True))], ["token", "early", "late"])


def multikey_order(words: np.ndarray) -> np.ndarray:
    """The order of rows of big-endian words: by the first word, ties by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    tied = np.zeros(len(order), np.int64)  # number of the tie that a place belongs to
    for depth in range(words.shape[1]):
        here = words[order, depth]
        new = np.concatenate(([True], (here[1:] != here[:-1]) | (tied[1:] != tied[:-1]))) if len(order) else np.empty(0, bool)
        tied = np.cumsum(new)
        if depth + 1 == words.shape[1]:
            break
        more = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(more):
            break
        order[more] = order[more][np.lexsort((words[order[more], depth + 1], tied[more]))]
    return order


def _common(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the more alike of its neighbours in sorted order."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    order = multikey_order(padded.view(">u8").astype(np.uint64))
    out = np.zeros(len(rows), np.int64)
    for at in range(0, len(rows) - 1, 1 << 16):
        pair = order[at : at + (1 << 16) + 1]
        differ = rows[pair[1:]] != rows[pair[:-1]]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[pair[1:]] = np.maximum(out[pair[1:]], shared)
        out[pair[:-1]] = np.maximum(out[pair[:-1]], shared)
    return out


def shared_strings(rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, place of the anchor) of the strings that also stand in another suffix with a smaller ``least``; no two rows are equal."""
    none = (np.empty(0, np.int64),) * 2
    low, high = (rows[:, BEFORE + LENGTH + k].astype(np.int64) for k in (0, 1))
    low = np.maximum(low, LENGTH - np.minimum(_common(rows[:, BEFORE : BEFORE + LENGTH]), LENGTH))
    alive = np.flatnonzero(low <= high)
    if len(alive) < 2:
        return none
    left = np.ascontiguousarray(rows[alive, : BEFORE + TOKEN][:, ::-1])
    top = np.minimum(high[alive], _common(left) - TOKEN)
    low = low[alive]
    number = np.maximum(top - low + 1, 0)
    of = np.repeat(np.arange(len(alive)), number)
    place = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + low[of]
    of = alive[of]
    if not len(of):
        return none
    flat = np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(rows).ravel(), LENGTH)

    def strings(which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), 56), np.uint8)
        out[:, :LENGTH] = flat[of[which] * _WIDTH + BEFORE - place[which]]
        return out

    hashed = np.concatenate([row_hashes(strings(np.arange(at, min(at + (1 << 16), len(of))))) for at in range(0, len(of), 1 << 16)])
    hashed ^= mix(place.astype(np.uint64))
    order = np.argsort(hashed, kind="stable")
    new = np.concatenate(([True], hashed[order[1:]] != hashed[order[:-1]]))
    for at in range(0, len(order) - 1, 1 << 16):  # equal hashes are held against the strings
        pair = order[at : at + (1 << 16) + 1]
        equal = np.flatnonzero(~new[at + 1 : at + len(pair)])
        if (strings(pair[equal + 1]) != strings(pair[equal])).any():
            text = strings(np.arange(len(of))).view("V56").ravel()
            _, kind = np.unique(text, return_inverse=True)
            order = np.argsort(kind, kind="stable")
            new = np.concatenate(([True], kind[order[1:]] != kind[order[:-1]]))
            break
    begin = np.flatnonzero(new)
    smallest = np.minimum.reduceat(least[of[order]], begin)
    larger = least[of[order]] > np.repeat(smallest, np.diff(np.append(begin, len(order))))
    return of[order[larger]], place[order[larger]]


def merged(spans: np.ndarray) -> np.ndarray:
    """(text, start, end) with spans of a text that meet made one."""
    if not len(spans):
        return spans.reshape(0, 3)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    new = np.concatenate(([True], spans[1:, 0] != spans[:-1, 0]))
    # ends so far, by text: each text's ends lie above those of the texts before
    lift = np.cumsum(new) * (int(spans[:, 2].max()) + 1)
    ends = np.maximum.accumulate(spans[:, 2] + lift) - lift
    opened = np.flatnonzero(new | np.concatenate(([True], spans[1:, 1] > ends[:-1])))
    out = spans[opened].copy()
    out[:, 2] = ends[np.append(opened[1:], len(spans)) - 1]
    return out


def bucket_spans(rows: np.ndarray, own: Occurrences) -> np.ndarray:
    """What the texts of a bucket's suffixes lose."""
    rows, own, lost = combined(rows, own)
    least = np.full(len(rows), np.iinfo(np.int64).max)
    np.minimum.at(least, own.kind, own.doc)  # one document for each suffix is left
    kind, place = shared_strings(rows, least)
    if not len(kind):
        return merged(lost)
    order = np.lexsort((place, kind))
    kind, place = kind[order], place[order]
    opened = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (place[1:] != place[:-1] + 1))))
    closed = np.append(opened[1:], len(kind)) - 1
    lows, highs, of = place[opened], place[closed], kind[opened]  # strings with neighbouring places overlap
    first, many = np.searchsorted(of, own.kind), np.searchsorted(of, own.kind, "right") - np.searchsorted(of, own.kind)
    who = np.repeat(np.arange(len(own.kind)), many)
    which = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + first[who]
    partly = np.stack((own.text[who], own.at[who] - highs[which], own.at[who] + LENGTH - lows[which]), 1)
    return merged(np.concatenate((lost, partly)))


def _sorted_bucket(table: pa.Table) -> pa.Table:
    groups, group = np.unique(table.column("group").to_numpy(), return_inverse=True)
    rows, own, count = [], [], 0
    for blob, g in zip(table.column("suffixes"), group, strict=True):
        if blob.is_valid:
            some, whose = _unpacked_suffixes(blob.as_py())
            whose.kind, whose.text = whose.kind + count, whose.text + (int(g) << 32)
            count += len(some)
            rows.append(some)
            own.append(whose)
    out = []
    if rows:
        kinds = np.concatenate(rows)
        rows.clear()
        lost = bucket_spans(kinds, Occurrences.joined(own))
        of = lost[:, 0] >> 32
        lost[:, 0] &= (1 << 32) - 1
        begin = np.searchsorted(of, np.arange(len(groups) + 1))
        out += [(int(groups[g]), _pack(lost[begin[g] : begin[g + 1]]), None) for g in np.unique(of)]
    handed = table.filter(pc.is_valid(table.column("texts")))
    out += [tuple(r.values()) for r in handed.select(list(_LOST)).to_pylist()]
    return pa.Table.from_batches([_answer(_LOST, out)])


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _by_document(table: pa.Table) -> pa.Table:
    """Spans by doc_id and key. A group that repeats has the same texts, so that either's answers hold."""
    texts = _unpack(next(b.as_py() for b in table.column("texts") if b.is_valid), np.int64)[0].reshape(-1, 2)
    spans = merged(np.concatenate([_unpack(b.as_py(), np.int64)[0].reshape(-1, 3) for b in table.column("lost") if b.is_valid] or [np.empty((0, 3), np.int64)]))
    begin = np.flatnonzero(np.concatenate(([True], spans[1:, 0] != spans[:-1, 0]))) if len(spans) else np.empty(0, np.int64)
    items = pa.StructArray.from_arrays([pa.array(spans[:, 1]), pa.array(spans[:, 2])], fields=list(_SPAN))
    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(spans)), pa.int32()), items)
    found = texts[spans[begin, 0]]
    return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1]), lists], ["doc_id", "key", "spans"])


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, key (xxhash64 of the text), spans (start, end; in bytes): what each text that loses something loses."""
    texts = _texts(docs).where("doc_id is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    sample = texts.mapInArrow(_sampled, "token long, early long, late long").toArrow() if buckets > 1 else None
    routes = Routes(buckets, sample)
    dealt = texts.mapInArrow(_emitted(routes), _ddl(_DEALT))
    lost = dealt.groupBy("bucket").applyInArrow(_sorted_bucket, _ddl(_LOST))
    found = lost.groupBy("group").applyInArrow(_by_document, f"doc_id long, key long, spans {_SPANS}")
    return found.groupBy("doc_id", "key").agg(F.first("spans").alias("spans"))  # a text that stands in several groups has the same spans in each


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in columns.items())


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            kept = []
            for text, spans in zip(piece.column("text").cast(pa.large_binary()), piece.column("spans"), strict=True):
                text = text.as_py()
                if spans.is_valid:
                    at, left = 0, []
                    for span in spans.as_py():
                        left.append(text[at : span["start"]])
                        at = span["end"]
                    text = b"".join((*left, text[at:]))
                kept.append(text)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.diff(text_bytes(piece.column("text"))[1])), piece.column("spans"), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start, end; null if none) and kept (the bytes that are left) for each row of ``docs`` (doc_id, text)."""
    found = _texts(docs).join(repeats(docs), ["doc_id", "key"], "left").select("doc_id", "text", "spans")
    return found.mapInArrow(_cut, f"doc_id long, n_bytes long, spans {_SPANS}, kept binary")

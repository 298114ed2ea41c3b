"""SentencePiece encoding and decoding as a relational lattice."""

from __future__ import annotations

import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.pieces import MODEL_PATH, SPACE, PieceTable, load_pieces
from quillrank.llm.shared import Scratch, give_back, tidy

LONG_WORD = 256       # longer words take the row-wise form of the same search
SHARE_CHARS = 8_000_000   # about how many characters of text share one list of words
_PACK_WORDS = 200_000     # words whose pieces are packed at a time
_BARE = 1 << 21       # above all ids; code points without a piece are counted from here
_STEP_WORDS = 250_000     # words of a share that become pieces at a time
_SLICE = 200
_BINS = 16            # parts of the words for each partition, so that partitions get about as many
_COST_BITS = 16       # costs are whole numbers of 1 / 2 ** 16, so sums are exact
_BYTE_COST = 14 << _COST_BITS   # of a byte that no piece covers

_LETTER = "A-Za-z\xc0-\u1fff\u3040-\ud7ff"   # blocks of letters; the rest counts as marks
# Ways to cut a text, finest first: runs of letters or of marks with the spaces before them, single
# digits; or words with the spaces before them.
_CUTS = (
    rf"\n|[0-9]| *[{_LETTER}]+| *[^ \n0-9{_LETTER}]+| +",
    r"\n| *[^ \n]+| +",
)


def piece_costs(table: PieceTable) -> dict[str, tuple[int, int]]:
    """``{piece, its marks as spaces: (id, cost)}``. A BPE model ranks its pieces (score = minus the
    rank) and has no probabilities. Zipf's law turns ranks into costs, ln(rank + 2), so the cheapest
    segmentation is the likeliest under unigrams of that law."""
    return {
        p.text.replace(SPACE, " "): (p.id, round(float(np.log(2.0 - p.score)) * (1 << _COST_BITS)))
        for p in table.pieces
    }


def word_pattern(costs: dict[str, tuple[int, int]]) -> str:
    """The finest cut that runs through no piece: then the best segmentations of the words are
    together the best of the text. Where a cut falls depends on the two characters beside it
    alone, so looking at every piece by itself is enough."""
    for cut in _CUTS:
        if all(re.fullmatch(cut, piece) for piece in costs):
            return cut
    raise ValueError("a piece holds a line feed or a space behind another character")


def best_pieces(word: str, costs: dict[str, tuple[int, int]], longest: int) -> list[int]:
    """The lattice search for one word, in memory linear in its length, with ids as in
    ``_lattice``. Ties go to the shorter last piece, here and there."""
    size = len(word)
    best, back = [0] + [float("inf")] * size, [(0, -1)] * (size + 1)
    for end in range(1, size + 1):
        for length in range(1, min(longest, end) + 1):
            part = word[end - length:end]
            found = costs.get(part)
            if found is None and length == 1:
                found = (-1, _BYTE_COST * len(part.encode("utf-8", "surrogatepass")))
            if found is not None and best[end - length] + found[1] < best[end]:
                best[end], back[end] = best[end - length] + found[1], (length, found[0])
    ids, at = [], size
    while at:
        length, piece = back[at]
        part = word[at - length:at]
        ids.append(piece if piece >= 0 else -1 - ord(part))
        at -= length
    return ids[::-1]


def _lattice(words: DataFrame, costs: dict[str, tuple[int, int]]) -> DataFrame:
    """``(word, ids, places)`` of ``words(bin, word, places)``, distinct words; an id below zero is minus one minus
    a code point that no piece covers. The pieces of a row spell its word.

    The substrings of a word, up to the longest piece, meet the piece table on equal terms.
    What matches are the edges of its lattice; they are grouped by word and folded from left
    to right. The state of the fold is the best way to each position so far, its cost and last
    piece: edges come by end, so an edge concerns the last position or the next. A second fold walks
    back from the end and spells the pieces.
    The table is a fixed vocabulary, so it is broadcast. ``words`` are placed by bin already, which
    follows from the word, so neither the grouping nor the fold exchanges anything; as they are sorted, the grouping meets
    its edges in order. Places go with the first edge of a word alone. An edge is one number, read from its highest bits: end (10), cost (22), size (9) and
    what it writes (22), which is the id of a piece or, from ``_BARE`` on, a code point without one. A
    way is the same with its whole cost in front, so the smaller number is the better way.
    """
    longest = max(map(len, costs))
    pieces = words.sparkSession.createDataFrame([
        (piece, (cost << 31) + i) for piece, (i, cost) in costs.items()
    ], "piece string, says long")
    ends = words.sortWithinPartitions("word").select(
        "bin", "word", "places", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("end")
    )
    spans = ends.select("bin", "word", "places", "end", F.explode(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.col("end")))
    ).alias("size")).select(
        "bin", "word", "end", "size", F.when(F.col("end") == 1, F.col("places")).alias("places"),
        F.substring(F.col("word"), F.col("end") - F.col("size") + 1, F.col("size")).alias("piece"),
    )
    matched = spans.join(F.broadcast(pieces), "piece", "left").where("says is not null or size = 1")
    bare = F.octet_length("piece") * F.lit(_BYTE_COST << 31) + F.ascii("piece") + F.lit(_BARE)
    edges = matched.select("bin", "word", "places", (
        F.shiftleft(F.col("end").cast("long"), 53) + F.shiftleft(F.col("size").cast("long"), 22)
        + F.coalesce("says", bare)
    ).alias("edge"))
    def size(way: Column) -> Column:
        return F.shiftright(way, 22).bitwiseAND(0x1FF).cast("int")

    def follow(ways: Column, edge: Column) -> Column:
        end = F.shiftright(edge, 53).cast("int")
        cost_before = F.get(ways, end - size(edge)).bitwiseAND(-1 << 31)
        way = cost_before + edge.bitwiseAND((1 << 53) - 1)
        return F.when(F.size(ways) <= end, F.concat(ways, F.array(way))).when(
            way < F.get(ways, end), F.concat(F.slice(ways, F.lit(1), end), F.array(way))
        ).otherwise(ways)

    def walk_back(state: Column, end: Column) -> Column:
        way = F.get(F.col("ways"), end)
        written = way.bitwiseAND(0x3FFFFF)
        piece = F.when(written < _BARE, written).otherwise(_BARE - 1 - written).cast("int")
        return F.when(state["at"] == end, F.struct(
            (end - size(way)).alias("at"), F.concat(F.array(piece), state["ids"]).alias("ids")
        )).otherwise(state)

    grouped = edges.groupBy("word", "bin").agg(
        F.collect_list("edge").alias("edges"), F.first("places", ignorenulls=True).alias("places")
    )
    folded = grouped.select("word", "places", F.aggregate(
        F.sort_array("edges"), F.array(F.lit(0).cast("long")), follow
    ).alias("ways"))
    length = F.length("word")
    last = F.struct(length.alias("at"), F.array().cast("array<int>").alias("ids"))
    ids = F.aggregate(F.sequence(length, F.lit(1), F.lit(-1)), last, walk_back)["ids"]
    return folded.select("word", ids.alias("ids"), "places")


def _slices(batches):
    """Few rows at a time, so that few texts are Python objects at once."""
    for batch in batches:
        for first in range(0, len(batch), _SLICE):
            yield batch.slice(first, _SLICE)


def _shares(
    docs: DataFrame, key: str, text: str, costs: dict[str, tuple[int, int]], share_chars: int, bins: int
) -> DataFrame:
    """``(share, script, words)``: consecutive texts of a task, about ``share_chars`` characters together,
    as one packed row. ``script``: keys, words per text (-1: null), the words of all texts as numbers, the pieces of
    long words, and the bin of every word (``bins``: long); ``words``: the distinct words but the long ones by bin, in a
    bin by number, with the bins and how many words each has."""
    longest, pattern = max(map(len, costs)), word_pattern(costs)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = re.compile(pattern).findall
        task, count = TaskContext.get().partitionId(), 0

        def share() -> pa.RecordBatch:
            words = list(number)
            long = {
                i: best_pieces(word, costs, longest)
                for i, word in enumerate(words) if len(word) > LONG_WORD
            }
            numbers = np.concatenate(texts) if texts else np.zeros(0, "<i4")
            bin_of = np.fromiter((
                bins if i in long else zlib.crc32(word.encode("utf-8", "surrogatepass")) % bins
                for i, word in enumerate(words)
            ), "<i4", len(words))
            placed = _by_bin(bin_of)[:len(words) - len(long)]
            found, counts = np.unique(bin_of[placed], return_counts=True)
            columns = [
                pa.array([zstandard.compress(pickle.dumps(told))], pa.binary())
                for told in (
                    (keys, sizes, _planes(numbers), long, _planes(bin_of)),
                    (found.tolist(), counts.tolist(), [words[i] for i in placed]),
                )
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 20) + count], pa.int64()), *columns],
                ["share", "script", "words"],
            )

        def fresh():
            words = defaultdict()
            words.default_factory = words.__len__
            return words, [], [], [], 0

        number, keys, sizes, texts, chars = fresh()
        for batch in _slices(batches):
            for name, value in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                keys.append(name)
                if value is None:
                    sizes.append(-1)
                    continue
                found = words_of(" " + value)
                sizes.append(len(found))
                texts.append(np.fromiter(map(number.__getitem__, found), "<i4", len(found)))
                chars += len(value)
                if chars >= share_chars:
                    yield share()
                    number, keys, sizes, texts, chars = fresh()
                    count += 1
        if keys:
            yield share()

    named = docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    return named.mapInArrow(tidy(split), "share long, script binary, words binary")


def _words(shares: DataFrame) -> DataFrame:
    """``(bin, share, at, words)``: the distinct words of every share but the long ones, one row for a share and a bin. The
    place of the first one in the share's order is ``at``. Words stand in lines; no word holds a line feed but the
    line feed itself, which is an empty line."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for share, packed in zip(batch["share"].to_pylist(), batch["words"], strict=True):
                bins, counts, words = pickle.loads(zstandard.decompress(packed.as_py()))
                firsts = [0, *np.cumsum(counts).tolist()]
                lines = [
                    "\n".join("" if word == "\n" else word for word in words[first:last])
                    for first, last in zip(firsts, firsts[1:])
                ]
                yield pa.RecordBatch.from_arrays([
                    pa.array(bins, pa.int32()), pa.array([share] * len(bins), pa.int64()),
                    pa.array(firsts[:-1], pa.int32()), pa.array(lines, pa.string()),
                ], ["bin", "share", "at", "words"])

    return shares.mapInArrow(tidy(unpack), "bin int, share long, at int, words string")


def _by_bin(bins: np.ndarray) -> np.ndarray:
    """The numbers of words by bin, in a bin ascending."""
    return np.argsort(bins, kind="stable")


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + length`` of all rows, one after the other."""
    until = np.cumsum(lengths)
    return np.repeat(starts - until + lengths, lengths) + np.arange(until[-1] if len(until) else 0)


def _planes(numbers: np.ndarray) -> bytes:
    """Byte by byte, lowest first, as that compresses better."""
    return np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _packed(known: DataFrame) -> DataFrame:
    """``(part, words)`` of ``known(part, at, ids)``: the rows of some batches, by part, as one packed row
    each, so that little is exchanged."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        part, at = rows["part"].to_numpy(), rows["at"].to_numpy()
        ids = rows["ids"].combine_chunks()
        lengths = pc.list_value_length(ids).to_numpy()
        flat = ids.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        order = np.lexsort((at, part))
        parts, firsts = np.unique(part[order], return_index=True)
        blobs = []
        for chosen in np.split(order, firsts[1:]):
            spelled = flat[_places(starts[chosen], lengths[chosen])]
            blobs.append(zstandard.compress(pickle.dumps((
                _planes(np.diff(at[chosen], prepend=0)), _planes(lengths[chosen]), _planes(spelled)
            ))))
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], ["part", "words"]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += len(batch)
            if count >= _PACK_WORDS:
                yield packed(pa.Table.from_batches(waiting))
                waiting, count = [], 0
        if count:
            yield packed(pa.Table.from_batches(waiting))

    return known.mapInArrow(tidy(pack), "part long, words binary")


def _put_together(byte_ids: tuple[int, ...]):
    """The function that makes ``(id, ids)`` of a share's script and the pieces of its words."""

    def spelled(ids: list[int]) -> list[int]:
        parts = ([i] if i >= 0 else [byte_ids[b] for b in chr(-1 - i).encode()] for i in ids)
        return [i for part in parts for i in part]

    def put_together(scripts: pa.Table, known: pa.Table) -> pa.Table:
        (script,) = scripts["script"].to_pylist()
        keys, sizes, planes, long, bins = pickle.loads(zstandard.decompress(script))
        numbers = _numbers(planes)
        blocks = [
            [_numbers(part) for part in pickle.loads(zstandard.decompress(block))]
            for block in known["words"].to_pylist()
        ]
        none = [np.zeros(0, "<i4")]
        at = _by_bin(_numbers(bins))[np.concatenate([np.cumsum(block[0]) for block in blocks] or none)]
        lengths = np.concatenate([block[1] for block in blocks] or none)
        flat = np.concatenate([block[2] for block in blocks] or none)
        starts = np.cumsum(lengths) - lengths
        others, extra = dict(long), []
        for row in np.unique(np.repeat(np.arange(len(at)), lengths)[flat < 0]):
            others[at[row]] = flat[starts[row]:starts[row] + lengths[row]].tolist()
        n_words = max(numbers.max(initial=-1), at.max(initial=-1)) + 1
        start, length = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
        start[at], length[at] = starts, lengths
        end = len(flat)
        for word, ids in others.items():
            extra.append(np.array(spelled(ids), flat.dtype))
            start[word], length[word] = end, len(extra[-1])
            end += len(extra[-1])
        flat = np.concatenate([flat, *extra])
        if not length[numbers].all():
            raise RuntimeError("a share has words without pieces")
        ends = np.cumsum(np.maximum(sizes, 0))
        tables, first, taken = [], 0, 0
        while first < len(keys):    # some million words at a time
            last = max(first + 1, int(np.searchsorted(ends, taken + _STEP_WORDS, "right")))
            words = numbers[taken:ends[last - 1]]
            n = length[words]
            until = np.cumsum(n)
            ids = flat[_places(start[words], n)]
            bounds = np.concatenate([[0], until])[np.concatenate([[taken], ends[first:last]]) - taken]
            lists = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()),
                mask=pa.array([size < 0 for size in sizes[first:last]]),
            )
            tables.append(pa.table({"id": pa.array(keys[first:last], pa.string()), "ids": lists}))
            first, taken = last, ends[last - 1]
        return pa.concat_tables(tables)

    def tidied(scripts: pa.Table, known: pa.Table) -> pa.Table:
        table = put_together(scripts, known)
        give_back()
        return table

    return tidied


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL_PATH,
    share_chars: int = SHARE_CHARS,
) -> DataFrame:
    """``(<key>, ids)``, one row per row of ``docs``: the piece ids of the cheapest segmentation of
    the whole text, characters without a piece as byte pieces. Decoding gives the text back.

    A null text has null ids, an empty one the single space piece. Repeated rows get equal
    answers, other columns are not read. Texts are cut into words where they are read, and
    numbered in shares of about ``share_chars`` characters (or one longer text); no text is
    exchanged. The shares are written to the shared folder, by the hash of their number, and read from there, so a lost
    executor changes nothing in them. Their distinct words are placed by
    bins that follow from the word, many of a share in one row; every distinct word of all texts is segmented once, there, and its pieces go to the shares
    that hold it, packed: a frequent word is one narrow row per share, whatever its count. A word of more
    than LONG_WORD characters is segmented in its share, by the same search. The key is a number
    or a string.
    """
    table = load_pieces(path)
    costs = piece_costs(table)
    # named, so that small partitions stay apart: what a lattice needs is many times its words
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = Scratch(docs.sparkSession).bucketed(
        "shares", _shares(docs, key, text, costs, share_chars, _BINS * parts), "share", parts
    )
    lines = _words(shares.select("share", "words")).repartition(parts, "bin").select(
        "bin", "share", "at", F.posexplode(F.split("words", "\n")).alias("line", "word")
    )
    words = lines.select(
        F.when(F.col("word") == "", "\n").otherwise(F.col("word")).alias("word"), "bin",
        F.struct("share", (F.col("at") + F.col("line")).alias("at")).alias("place"),
    ).groupBy("word", "bin").agg(F.collect_list("place").alias("places"))
    known = _lattice(words, costs).select("ids", F.explode("places").alias("place")).select(
        F.col("place.share").alias("part"), "place.at", "ids"
    )
    scripts = shares.select("share", "script")
    joined = scripts.groupBy("share").cogroup(_packed(known).groupBy("part"))
    kind = dict(docs.dtypes)[key]
    return joined.applyInArrow(
        _put_together(table.byte_ids), "id string, ids array<int>"
    ).select(F.col("id").cast(kind).alias(key), "ids")


def decode(ids: Column, path: str = MODEL_PATH) -> Column:
    """The text of a column of piece ids, byte pieces joined; null for null.

    Column functions alone: the stage that puts the ids together has Python workers already, and a second
    pair beside them counts in an executor's memory. Pieces are hex digits on the way, as bytes of one
    character may stand in several."""
    model = load_pieces(path)
    of_id = {p.id: p.text.replace(SPACE, " ").encode() for p in model.pieces}
    of_id |= {i: bytes([b]) for b, i in enumerate(model.byte_ids)}
    digits = " ".join(of_id.get(i, b"").hex() for i in range(max(of_id) + 1))
    pieces = F.split(F.lit(digits), " ")   # folded to a constant
    spelled = F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1)), "")
    text = F.make_valid_utf8(F.unhex(spelled).cast("string"))
    return F.substring(text, F.lit(2), F.length(text))

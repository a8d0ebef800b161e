"""Packing tokenised documents into as few sequences as it can: minimum bin slack.

Each document becomes token ids and an end id; longer ones than a sequence are cut into pieces of
its whole length, the last may be shorter. Sequences are then filled one after the other: a sequence
begins with the longest piece left, and a dynamic programme over the lengths still available, its
reachable sums held as the bits of one integer, finds the combination that leaves the least slack.
That combination is removed, as often as the pieces left allow: a sequence that was the fullest
stays so while its pieces last.

Only lengths matter, and there are at most ``capacity`` of them. So the driver sees one count per
length, however many pieces there are, and hands back patterns: which lengths a run of sequences
has, and how many such sequences. Every piece has a number among those of its length; the number
gives its pattern, sequence and offset by a search in the pattern's intervals. Numbers come from counts
of slices of each length, so a length that holds a third of all pieces is numbered by many tasks.

Texts are read once. Tokens are found by whole words between ASCII spaces, which the vocabulary's
pre-tokeniser never crosses (``splits_at_spaces`` refuses tokenisers where it might). The distinct words of
some texts are looked up at once, as Arrow arrays, by their runs of letters, digits and signs. A very long text is cut into pieces as it is read.

Defined results: null and empty texts are the end id alone. Each row is a document: repeated rows and
ids are packed one by one, a null id stays null. Other columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from closebell.llm.words import parts
from closebell.session import stage

PIECES_PER_SLICE = 5_000  # expected
PIECES_PER_FILE = 100_000  # of the result, or as many files as the cluster runs tasks
REMEMBERED_BYTES = 1 << 24  # of words and their ids, some 400,000, that a worker keeps
TOGETHER = 1_000  # new words encoded in one call
CHUNK_BYTES = 1 << 23  # of texts whose words are looked up together

Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, copies), ...), sequences


def splits_at_spaces(path: str) -> bool:
    """Whether words between spaces can be tokenised one by one: spaces are dropped by the
    pre-tokeniser's pattern, and nothing is put in front of a text."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    steps = (made.get("pre_tokenizer") or {}).get("pretokenizers", [made.get("pre_tokenizer") or {}])
    first = steps[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    normal = (made.get("normalizer") or {}).get("normalizers", [made.get("normalizer") or {}])
    plain = {"NFC", "Replace", "Lowercase", None}
    return bool(
        drops and r"\s" not in first["pattern"].get("Regex", r"\s").replace(r"[^\s", "")
        and all(n.get("type") in plain for n in normal)
        and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in made["added_tokens"])
    )


# ASCII and Latin-1 letters, and signs. Where the pre-tokeniser keeps runs of letters, digits and runs of
# signs apart, each is tokenised by itself.
_LETTERS = string.ascii_letters + "".join(map(chr, sorted({*range(0xC0, 0x100)} - {0xD7, 0xF7})))
_SIGNS = string.punctuation.replace("'", "")
_RUN = f"([{_LETTERS}]+|[0-9]|[{re.escape(_SIGNS)}]+)"


def _parts_letters(made: dict) -> bool:
    """Whether runs of letters, digits and runs of signs are words of their own, and words end in a
    marked token."""
    steps = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    pattern = steps[0].get("pattern", {}).get("Regex", "").split("|")
    runs = {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"}
    others = {p for p in pattern if not p.startswith("'")} - runs
    return bool(runs <= set(pattern) and others == {r"[\p{N}]"}
                # no letters with signs after them hold such a token
                and all(re.search("[^A-Za-z][A-Za-z]", t["content"]) for t in made["added_tokens"])
                and made["model"].get("end_of_word_suffix"))


def _for_letters(made: dict) -> dict:
    """The tokeniser without the steps that leave words of lower-case ASCII and Latin-1 letters,
    one space apart, as they are."""
    normal = made.get("normalizer") or {}
    for step in normal.get("normalizers", [normal]):
        spaces = step.get("type") == "Replace" and step.get("pattern") == {"Regex": r"\s+"} and step.get("content") == " "
        if not spaces and step.get("type") not in ("NFC", "Lowercase", None):
            return made
    steps = [{"type": "WhitespaceSplit"}, *made["pre_tokenizer"]["pretokenizers"][1:]]
    return {**made, "normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}


def _binary(values: bytes, ends: np.ndarray) -> pa.LargeBinaryArray:
    """``values`` cut at ``ends``."""
    at = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(values)])


def _merged(mask: pa.Array, where: pa.Array, elsewhere: pa.Array) -> pa.Array:
    """The values of ``where``, in order, for true rows of ``mask``, and of ``elsewhere`` for others."""
    own = mask.to_numpy(zero_copy_only=False)
    place = np.where(own, np.cumsum(own) - 1, len(where) - 1 + np.cumsum(~own))
    return pa.concat_arrays([where, elsewhere]).take(pa.array(place))


def _remembered(encode):
    """``encode`` for words not met before. When too much is known, only what was asked for last is
    kept, so frequent words stay."""
    known = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def ids(words: pa.Array) -> pa.Array:
        nonlocal known
        at = pc.index_in(words, value_set=known[0])
        new = words.filter(at.is_null())
        names, found = pa.concat_arrays([known[0], new]), pa.concat_arrays([known[1], encode(new)])
        is_new = at.is_null().to_numpy(zero_copy_only=False)
        place = np.where(is_new, len(known[0]) - 1 + np.cumsum(is_new), at.fill_null(0).to_numpy())
        asked = found.take(pa.array(place))
        known = (names, found) if names.nbytes + found.nbytes <= REMEMBERED_BYTES else (words, asked)
        return asked

    return ids


@lru_cache(maxsize=2)
def _looked_up(path: str):
    """``ids(words) -> ids of each word``, little-endian; words are distinct.

    Runs of letters are lower-cased, and those not met before encoded together and told apart by the
    tokens that end a word. Most words are such a run and maybe signs; words of more runs are parted by
    a pattern. Those with other characters or with tokens of their own are encoded one by one.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    lowers = "Lowercase" in json.dumps(made["normalizer"])
    vocabulary = tokenizer.get_vocab()
    suffix = made["model"].get("end_of_word_suffix") or ""
    is_end = np.zeros(max(vocabulary.values()) + 1, bool)
    is_end[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
    by_letters = _parts_letters(made)
    of_letters = Tokenizer.from_str(json.dumps(_for_letters(made))) if by_letters else tokenizer
    own_tokens = [t["content"] for t in made["added_tokens"]]
    del made, vocabulary  # some 100,000 strings; what is looked up stays as long as the worker

    def one_by_one(words: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(words), TOGETHER):
            some = tokenizer.encode_batch_fast(words.slice(at, TOGETHER).to_pylist(), add_special_tokens=False)
            found += [np.array(e.ids, "<u4").tobytes() for e in some]
        return pa.array(found, pa.large_binary())

    def together(words: pa.Array) -> pa.Array:
        found = [np.empty(0, "<u4")]
        for at in range(0, len(words), TOGETHER):
            text = " ".join(words.slice(at, TOGETHER).to_pylist())
            found.append(np.array(of_letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(is_end[ids]) + 1
        if len(ends) != len(words):
            raise ValueError(f"{path} does not end each word with a marked token")
        return _binary(ids.tobytes(), 4 * ends)

    of_words, of_others = _remembered(together), _remembered(one_by_one)

    def of_cores(words: pa.Array) -> pa.Array:
        # lower-casing such letters first changes nothing
        words = (pc.utf8_lower(words) if lowers else words).dictionary_encode()
        return of_words(words.dictionary).take(words.indices)

    def of_runs(words: pa.Array) -> pa.Array:
        is_core = pc.and_(pc.equal(pc.utf8_ltrim(words, characters=_LETTERS), ""), pc.not_equal(words, ""))
        return _merged(is_core, of_cores(words.filter(is_core)), of_others(words.filter(pc.invert(is_core))))

    def of_mixed(words: pa.Array) -> pa.Array:
        known_runs = pc.match_substring_regex(words, f"^{_RUN}+$")
        for token in own_tokens:
            known_runs = pc.and_not(known_runs, pc.match_substring(words, token, ignore_case=True))
        parted = pc.replace_substring_regex(words.filter(known_runs), _RUN, r"\1 ")
        return _merged(
            known_runs, pa.array(list(_encoded(parted, of_runs)), pa.large_binary()),
            of_others(words.filter(pc.invert(known_runs))))

    def ids(words: pa.Array) -> pa.Array:
        words = words.cast(pa.string())
        if not by_letters:
            return of_others(words)
        cores, rests = pc.ascii_rtrim(words, characters=_SIGNS), pc.utf8_ltrim(words, characters=_LETTERS)
        size = pc.binary_length
        # the letters before the first other sign and what is before the signs at the end are the same
        is_split = pc.and_(
            pc.equal(pc.add(size(cores), size(rests)), size(words)), pc.greater(size(cores), 0))
        cores, rests = cores.filter(is_split), rests.filter(is_split).dictionary_encode()
        split = pc.binary_join_element_wise(
            of_cores(cores), of_others(rests.dictionary).take(rests.indices), pa.scalar(b"", pa.large_binary()))
        return _merged(is_split, split, of_mixed(words.filter(pc.invert(is_split))))

    return ids


def _encoded(texts: pa.Array, ids_of) -> Iterator[bytes]:
    """The ids of each text, four bytes each. Every distinct word of them is looked up once."""
    words = pc.ascii_split_whitespace(texts)
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    words = words.flatten().dictionary_encode()
    found = ids_of(words.dictionary).take(words.indices)
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(found).to_numpy())))[ends].tolist()
    ids, start = found.buffers()[2] or pa.py_buffer(b""), 0
    for end in ends:
        yield ids.slice(start, end - start).to_pybytes()
        start = end


def _encoder(path: str):
    """``ids(words) -> bytes``: the little-endian ids of words, one after the other."""
    ids_of = _looked_up(path)
    return lambda words: b"".join(_encoded(pa.array([b" ".join(words).decode()]), ids_of))


def _in_chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES``; a longer text is a range of its own."""
    start, held = 0, 0
    for n, size in enumerate(pc.binary_length(texts).to_pylist()):
        if n > start and held + size > CHUNK_BYTES:
            yield start, n
            start, held = n, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _pieces_of(ids: bytes, end_id: int, capacity: int) -> Iterator[bytes]:
    ids += end_id.to_bytes(4, "little")
    for at in range(0, len(ids), 4 * capacity):
        yield ids[at:at + 4 * capacity]


def cut(text: str | None, encode, end_id: int, capacity: int) -> Iterator[bytes]:
    """The ids of a document, four bytes each, in pieces."""
    size, held = 4 * capacity, b""
    for part in parts((text or "").encode()):
        held += encode(part.split())
        whole = len(held) - len(held) % size
        for at in range(0, whole, size):
            yield held[at:at + size]
        held = held[whole:]
    yield held + end_id.to_bytes(4, "little")


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and a spread ``_key``, from one pass over texts."""
    if not splits_at_spaces(tokenizer):
        raise ValueError(f"{tokenizer} does not split texts at spaces")
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = StructType([
        StructField("doc_id", given.schema["doc_id"].dataType),
        *[StructField(c, LongType()) for c in ("piece", "start", "length", "ids_crc32", "_key")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, encode, number = _looked_up(tokenizer), _encoder(tokenizer), 0
        for batch in batches:
            rows, texts = [], pc.fill_null(batch["text"], "")
            for first, last in _in_chunks(texts):
                chunk = texts.slice(first, last - first)
                if len(chunk) == 1:  # may be very long
                    found = [cut(chunk[0].as_py(), encode, end_id, capacity)]
                else:
                    found = (_pieces_of(ids, end_id, capacity) for ids in _encoded(chunk, ids_of))
                for doc, parts_of in enumerate(found, first):
                    start = 0
                    for n, ids in enumerate(parts_of):
                        crc, length = zlib.crc32(ids), len(ids) // 4
                        rows.append((doc, n, start, length, crc, number))
                        start, number = start + length, number + 1
            doc, *columns = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(doc)), *map(pa.array, columns)], schema.names)

    found = given.mapInArrow(run, schema)
    # the number in the task spreads equal rows, too; it is fixed once the table is written
    return found.withColumn("_key", F.xxhash64("doc_id", "piece", "ids_crc32", "_key"))


def fullest(available: list[tuple[int, int]], capacity: int) -> tuple[tuple[int, int], ...]:
    """The fullest combination of ``available`` (length, count), longest first, that fits: bit s of
    ``reached`` tells that some combination of the lengths so far adds up to s."""
    reached, mask, trail = 1, (1 << capacity + 1) - 1, []
    for length, count in available:
        before, left, copies = reached, min(count, capacity // length), 1
        trail.append((length, left, before))
        while left:
            step = min(copies, left)
            reached |= reached << step * length & mask
            left, copies = left - step, copies * 2
        if reached >> capacity:
            break
    best, chosen = reached.bit_length() - 1, []
    for length, most, before in reversed(trail):
        copies = next(m for m in range(most + 1)
                      if m * length <= best and before >> best - m * length & 1)
        if copies:
            chosen.append((length, copies))
            best -= copies * length
    return tuple(reversed(chosen))


def minimum_slack(counts: Mapping[int, int], capacity: int) -> list[Pattern]:
    """The patterns that use up all pieces, in the order they are found."""
    left = {length: n for length, n in counts.items() if n}
    lengths, patterns = sorted(left), []
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        fit = lengths[:bisect_right(lengths, capacity - longest)]
        rest = fullest([(x, left[x]) for x in reversed(fit) if left[x]], capacity - longest)
        left[longest] += 1
        pattern = dict(rest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[x] // n for x, n in pattern.items())
        patterns.append((tuple(sorted(pattern.items(), reverse=True)), times))
        for x, n in pattern.items():
            left[x] -= n * times
            if not left[x]:
                del lengths[bisect_right(lengths, x) - 1]
    return patterns


_RANKS = 44  # bits for a piece's number among those of its length


def _intervals(patterns: list[Pattern]) -> np.ndarray:
    """Rows of (length and first number, sequences, first sequence, offset) sorted by the first."""
    used, first, rows = {}, 0, []
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            start = used.get(length, 0)
            rows.append((length << _RANKS | start, times, first, offset))
            used[length] = start + copies * times
            offset += copies * length
        first += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def place(found: DataFrame, capacity: int = 4096) -> DataFrame:
    """``found`` (of ``pieces``, written) with ``sequence_id`` and ``offset``."""
    by_length = found.groupBy("length").agg(F.count("*").alias("_n"))
    # at most one row per length
    counts = {r.length: r["_n"] for r in by_length.collect()}
    table = _intervals(minimum_slack(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        length, number = length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = np.searchsorted(table[:, 0], length << _RANKS | number, side="right") - 1
        inside = number - (table[at, 0] & (1 << _RANKS) - 1)
        copy, sequence = np.divmod(inside, table[at, 1])
        return pd.DataFrame({
            "sequence_id": table[at, 2] + sequence, "offset": table[at, 3] + copy * length})

    sliced = found.join(by_length, "length").withColumn(
        "_slice", F.pmod("_key", F.ceil(F.col("_n") / PIECES_PER_SLICE)))
    sums = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_in"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0))).drop("_in")
    inside = Window.partitionBy("length", "_slice").orderBy(
        "_key", "doc_id", "piece", "start", "ids_crc32")
    numbered = sliced.withColumn("_inside", F.row_number().over(inside) - 1).join(
        sums, ["length", "_slice"])
    placed = numbered.withColumn(
        "_at", look_up(F.col("length"), (F.col("_before") + F.col("_inside")).cast("long")))
    # Rows are short: what many small shuffle partitions hold goes to few files, one task after the other
    files = max(found.sparkSession.sparkContext.defaultParallelism,
                -(-sum(counts.values()) // PIECES_PER_FILE))
    return placed.select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "_at.*",
    ).coalesce(files)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    found = stage(pieces(docs, tokenizer, capacity, end_id, id_column, text), "packing-pieces")
    return place(found, capacity)

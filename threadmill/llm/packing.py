"""Packing into sequences by shortest-pack-first over the length histogram.

Texts become token ids plus one end id each; pieces are cut at the sequence length, so only the
last piece of a document is shorter. Placing works on the histogram of piece lengths, which has
at most ``sequence`` entries however many documents there are: lengths go from the longest to
the shortest, each into the packs that are shortest among those with room, and a pack pattern
keeps a count. Patterns are joined back to the pieces by the rank of a piece within its length.

Null text counts as empty, an empty text is its end id alone, repeated rows are packed each on
their own, an empty table gives no pieces. Any id column may be null or repeat.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import local_table, ranges_for, ranked, resident, tidy
from threadmill.session import materialize

SEQUENCE = 1024
#: Words whose ids a worker remembers, in each of two generations.
REMEMBERED_WORDS = 100_000

_PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
_PLAN = pa.schema([(n, pa.int64()) for n in ("_length", "_from", "_to", "_sequence", "_offset")])


# Fixed value: how byte-level tokenizers cut a text.
_PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _rank_encoding(tokenizer):
    """The same vocabulary as a table of ranks, which is quicker on many words; None if it has not that form.

    A merge must come before another exactly if its token has the smaller id. Both ways must
    agree on the vocabulary's own words.
    """
    import json

    import tiktoken

    spec = json.loads(tokenizer.to_str())
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    letters, added = _byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [vocabulary.get(a + b, -1) for a, b in pairs]
    if order != sorted(set(order)) or -1 in order or not all(set(t) <= letters.keys() for t in vocabulary):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
    found = tiktoken.Encoding("ranks", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
    text = " ".join(b.decode("utf-8", "ignore") for b in list(ranks)[:: max(1, len(ranks) // 2000)])
    return found if found.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids else None


class _Ids:
    """Token ids of ``" word"`` as little-endian 32-bit bytes, found for many new words at once.

    Two generations: when the young one is full it becomes the old one, and a word of the old
    one that is met again moves up. So frequent words stay and the memory is bounded.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # a leading space
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

        self.ranks = _rank_encoding(tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of ``" word"`` for words without outer white space, encoded as one text and parted at the spaces."""
        text = " " + " ".join(words)
        if self.ranks is not None:
            found = self.ranks.encode_ordinary(text)
        else:
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids = np.array(found, "<u4")
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(words):
            return self.encode([" " + w for w in words])
        raw, ends = ids.tobytes(), (4 * at).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:] + [len(raw)])]

    def learn(self, words: set[str]) -> dict[str, bytes | None]:
        """A table that has all of ``words``; None for an empty one and one that white space begins or ends."""
        if len(self.young) > REMEMBERED_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = words.difference(young)
        known = new.intersection(old)
        young.update(zip(known, map(old.__getitem__, known)))
        new -= known
        plain = [w for w in new if w.strip() == w != ""]
        if len(plain) < len(new):
            young.update(dict.fromkeys(new.difference(plain)))
        for i in range(0, len(plain), 512):
            part = plain[i : i + 512]
            young.update(zip(part, self.words(part)))
        return young


def _ids(path: str) -> _Ids:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    def load() -> _Ids:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return _Ids(tokenizer)

    return resident(path, load)


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    The byte-level pre-tokenizer starts a token at every space between two other characters, so
    a text whose spaces all stand alone is encoded word by word, with the same ids. A text with
    other white space beside a space is encoded whole.
    """
    ids = _ids(path)
    split = [t.split(" ") for t in texts]
    first = [words[0] for words in split]
    for words in split:
        del words[0]
    known = ids.learn(set().union(*split)).__getitem__
    out: list[bytes] = []
    for text, head, words, begin in zip(texts, ids.encode(first), split, first):
        try:
            found = None if begin[-1:].isspace() else b"".join(map(known, words))
        except TypeError:  # a word without ids of its own
            found = None
        out.append(ids.encode([text])[0] if found is None else head + found)
    return out


def pieces(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = 0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Every document cut into pieces: doc_id, start, length, ids_crc32, doc_tokens, and whole numbers to ``keep``."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, start, length, crc, total = [], [], [], [], []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for i, found in enumerate(token_bytes(texts, tokenizer)):
                    found += end
                    n = len(found) // 4
                    for s in range(0, n, sequence):
                        piece = found[4 * s : 4 * (s + sequence)]
                        rows.append(i), start.append(s), length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece)), total.append(n)
                columns = [part.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                columns += [part.column(2 + k).take(pa.array(rows, pa.int64())) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *keep])

    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = "".join(f", `{c}` long" for c in keep)
    return docs.select("doc_id", "text", *keep).mapInArrow(tidy(cut, keeps=True), _PIECES.format(kind=kind) + kept)


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, how many such packs) that hold all of ``counts``, {length: pieces}."""
    # Packs by the room they have left; a pack without room is done.
    open_packs: dict[int, list[list]] = defaultdict(list)
    done: Counter = Counter()

    def put(lengths: tuple[int, ...], room: int, count: int) -> None:
        if room:
            open_packs[room].append([lengths, count])
        else:
            done[lengths] += count

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            # The most room belongs to the shortest pack.
            room = max((r for r, packs in open_packs.items() if packs), default=0)
            if room < length:
                break
            lengths, have = open_packs[room].pop()
            used = min(have, left)
            if used < have:
                open_packs[room].append([lengths, have - used])
            put(lengths + (length,), room - length, used)
            left -= used
        if left:
            fit = sequence // length
            full, rest = divmod(left, fit)
            if full:
                put((length,) * fit, sequence - fit * length, full)
            if rest:
                put((length,) * rest, sequence - rest * length, 1)
    for room, packs in open_packs.items():
        for lengths, count in packs:
            done[lengths] += count
    return sorted(done.items())


def pack_plan(counts: dict[int, int], sequence: int = SEQUENCE) -> list[dict]:
    """Where the pieces of each rank go: runs of ranks of a length, their first sequence, the offset."""
    placed: Counter = Counter()
    first, rows = 0, []
    for lengths, count in pack_histogram(counts, sequence):
        at = 0
        for length in lengths:
            rows.append({"_length": length, "_from": placed[length], "_to": placed[length] + count,
                         "_sequence": first, "_offset": at})
            placed[length] += count
            at += length
        first += count
    return rows


def pack(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = 0, order: tuple[str, str] | None = None
) -> DataFrame:
    """All documents in sequences: one row per piece with sequence_id and offset.

    Pieces of one length fill the sequences meant for them in the order of two whole-number
    columns, ``order``: the first numbers runs of rows of bounded size, such as files, the
    second rows in a run. Without it they come in a hashed order of doc_id and start.
    """
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, sequence, end_id, order or ())
    cut = materialize(cut.withColumn("_arrival", F.monotonically_increasing_id()), "pieces")
    # At most `sequence` rows come to the driver.
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = local_table(spark, pack_plan(counts, sequence), _PLAN)
    if order:
        part, by = F.col(order[0]), [F.col(order[1]), F.col("start"), F.col("_arrival")]
    else:
        part = F.pmod(F.xxhash64("doc_id", "start", "_arrival"), F.lit(ranges_for(sum(counts.values()))))
        by = [F.col("doc_id"), F.col("start"), F.col("_arrival")]
    rows = ranked(cut, "length", part, by, "_rank")
    # The plan has a few rows per length and pack pattern; the sequence length bounds both.
    met = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return rows.join(F.broadcast(plan), met).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )

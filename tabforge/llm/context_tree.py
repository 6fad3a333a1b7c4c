"""Language-model scoring by context-tree weighting over bytes.

A text is a sequence of bytes: its words (A-Z lowered) with one space between
them, then an end byte. Each byte is eight binary decisions. For every decision
a tree of contexts (the last 0 to ``depth`` bytes) holds Krichevsky-Trofimov
estimates, and weighting mixes the estimates of all depths: a node's weighted
probability is half its own estimate and half its children's product. Counts
come from the whole training corpus. The tree is cut below the two nearest bytes
of a context: subtrees are worked out apart, the levels above by one aggregation
a level towards the root and one join a level back.

Texts are counted and scored in blocks of neighbouring rows, cut by bytes of text
whatever the scan's splits are: a block asks the
tree for the byte strings it has, each once, in sorted compressed lists, so what
moves is far less than a row for each place in the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import table, written
from tabforge.llm.textbytes import Words, is_space, lowered, mixed, text_chunks

#: Bytes of the longest context. A context and the byte after it fit into one long.
DEPTH = 5
#: Bytes of input files that a task reads at least.
TASK_BYTES = 32 << 20
#: Bytes of text that make a block, whatever a task reads; a longer text is a block of its own. A group of the exchanges holds one block.
BLOCK_BYTES = 16 << 20
#: The byte that ends a text; it stands before a text's first byte as well.
END = 10
#: Stands for the end token among the hashes of words.
END_TOKEN = 0


def symbols(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte sequences of lowered texts, one after the other, and where each begins (with the total last)."""
    solid = ~is_space(raw)
    keep = solid | np.concatenate([[False], solid[:-1]])  # a word's bytes and one space after it
    out = np.where(solid, raw, 32)[keep]
    stops = np.cumsum(keep)[ends - 1]
    sizes = np.diff(stops, prepend=0)
    empty = sizes == 0
    out[stops[~empty] - 1] = END
    out = np.insert(out, stops[empty], END)
    return out, np.concatenate([[0], np.cumsum(np.maximum(sizes, 1))])


def strings(sym: np.ndarray, begin: np.ndarray, depth: int) -> np.ndarray:
    """For every byte its context and itself in one number: the byte lowest, then the context from near to far."""
    index = np.arange(len(sym)) - np.repeat(begin[:-1], np.diff(begin))
    code = sym.astype(np.int64)
    for k in range(1, depth + 1):
        before = np.full(len(sym), END, np.int64)
        before[k:] = sym[:-k] if k < len(sym) else before[k:]
        before[index < k] = END
        code |= before << (8 * k)
    return code


class Tally:
    """Counts by key, merged whenever the additions outnumber what is merged already."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, 500_000

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        keys, at = np.unique(keys, return_inverse=True)
        self.parts.append((keys, np.bincount(at, train, len(keys)).astype(np.int64)))
        self.size += len(keys)
        if self.size > self.limit:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in self.parts]), len(keys)).astype(np.int64)
        self.parts, self.size, self.limit = [(keys, counts)], 0, max(500_000, len(keys))
        return keys, counts


def sealed(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit numbers, compressed byte plane by byte plane; ascending ones by their differences."""
    numbers = numbers.view(np.uint64)
    if ascending:
        numbers = np.diff(numbers, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def opened(raw: bytes, n: int, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    numbers = np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)
    return np.cumsum(numbers, dtype=np.uint64) if ascending else numbers


def parts_of(keys: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which of 2**bits parts each of the sorted keys belongs to: (part, places of its keys, ascending)."""
    part = (mixed(keys) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
        yield int(part[order[a]]), order[a:b]


KEYS = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("body", pa.binary()), ("counts", pa.binary()),
                  ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))])


def in_blocks(docs: DataFrame, depth: int, bits: int, block_bytes: int) -> DataFrame:
    """The texts of ``docs`` in blocks, as compressed byte sequences, and what each block asks for.

    Rows of kind ``text`` hold some texts, with their ids, train flags and
    sizes; rows of kind ``string`` and ``word`` hold, for one part of the key
    space, the block's distinct keys and how often training rows have them
    (0: only other rows do). A partition's rows are cut into blocks as they
    come, so that no more than a block is ever held.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, filled = TaskContext.get().partitionId() << 32, 0
        asked = {"string": Tally(), "word": Tally()}

        def row(kind: str, part: int, n: int, body: bytes, counts=None, ids=None, train=None, sizes=None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((kind, block, part, n, body, counts, ids, train, sizes), KEYS)], schema=KEYS)

        def closed() -> Iterator[pa.RecordBatch]:
            for kind in asked:
                t, asked[kind] = asked[kind], Tally()
                keys, counts = t.merge() if t.parts else (np.zeros(0, np.uint64),) * 2
                for part, at in parts_of(keys, bits) if len(keys) else ():
                    yield row(kind, part, len(at), sealed(keys[at], True), sealed(counts[at]))
            pa.default_memory_pool().release_unused()

        for batch in batches:
            ids, train = batch.column("doc_id").to_pylist(), batch.column("train").to_numpy(zero_copy_only=False)
            for first, end, raw, ends in text_chunks(batch.column("text")):
                sym, begin = symbols(lowered(raw), ends)
                if filled and filled + len(sym) > block_bytes:
                    yield from closed()
                    block, filled = block + 1, 0
                filled += len(sym)
                own, size = train[first:end], np.diff(begin)
                yield row("text", 0, len(sym), pa.compress(sym.tobytes(), "zstd", asbytes=True), None, ids[first:end], own.tolist(), size.tolist())
                asked["string"].add(strings(sym, begin, depth).view(np.uint64), np.repeat(own, size))
                w = Words(sym, begin[1:])
                asked["word"].add(np.concatenate([w.hash, np.full(end - first, END_TOKEN, np.uint64)]), np.concatenate([np.repeat(own, np.diff(w.of)), own]))
        yield from closed()

    return docs.select("doc_id", "train", "text").mapInArrow(
        tally, "kind string, block long, part long, n long, body binary, counts binary, ids array<long>, train array<boolean>, sizes array<long>")


def gathered(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys of a part, their counts over all blocks, and where each block's keys lie among them."""
    pa.default_memory_pool().release_unused()  # what the group before held
    lists = [opened(b, n, True) for b, n in zip(asked.column("body").to_pylist(), asked.column("n").to_pylist())]
    keys, at = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.concatenate([opened(b, n) for b, n in zip(asked.column("counts").to_pylist(), asked.column("n").to_pylist())])
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, counts.view(np.int64))
    return keys, total, np.split(at, np.cumsum([len(x) for x in lists])[:-1])


ANSWER = "kind string, block long, part long, n long, body binary, value binary"


def answers(asked: pa.Table, keys: np.ndarray, values: np.ndarray, places: list[np.ndarray]) -> pa.Table:
    value = [sealed(values[p].view(np.uint64)) for p in places]
    return pa.table({"kind": asked.column("kind"), "block": asked.column("block"), "part": asked.column("part"), "n": asked.column("n"), "body": asked.column("body"), "value": pa.array(value, pa.binary())})


def ln_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of so many zeros and ones under the Krichevsky-Trofimov estimate."""

    def ln_gamma(x: np.ndarray) -> np.ndarray:  # Stirling's series from x + 6, for x >= 0.5
        y = x + 6
        product = x * (x + 1) * (x + 2) * (x + 3)
        return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product) - np.log((x + 4) * (x + 5))

    return ln_gamma(zeros + 0.5) + ln_gamma(ones + 0.5) - ln_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Nodes:
    """The nodes of one depth, by ``context << 8 | decision``: counts of zeros and ones, log estimate and log weighted
    probability, and the weight of the node's own estimate."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.key, self.zeros, self.ones = key, zeros, ones
        estimate = ln_kt(zeros, ones)
        self.ln_w = estimate if below is None else np.logaddexp(estimate, below) - math.log(2)
        self.own = np.ones(len(key)) if below is None else np.exp(estimate - math.log(2) - self.ln_w)
        self.one = (ones + 0.5) / (zeros + ones + 1.0)  # the estimate of a one

    def parents(self, depth: int) -> tuple[Nodes, np.ndarray]:
        """The nodes whose contexts lack these ones' farthest byte, down to ``depth`` bytes, and each node's place among them."""
        up = (self.key >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8) | self.key & np.uint64(255)
        key, at = np.unique(up, return_inverse=True)
        add = lambda x: np.bincount(at, x, len(key))
        return Nodes(key, add(self.zeros), add(self.ones), add(self.ln_w)), at


def subtree(strings: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[Nodes], list[np.ndarray], np.ndarray]:
    """Nodes of depths ``depth`` to ``top`` for byte strings and their counts; places of each level's parents; the
    deepest node of each string's eight decisions."""
    strings = strings.astype(np.uint64)
    context, byte = strings >> np.uint64(8) << np.uint64(8), (strings & np.uint64(255)).astype(np.int64)
    step = np.arange(8)
    decision = (1 << step) | (byte[:, None] >> (8 - step))
    key, at = np.unique((context[:, None] | decision.astype(np.uint64)).ravel(), return_inverse=True)
    bit = ((byte[:, None] >> (7 - step)) & 1).ravel()
    times = np.repeat(n.astype(np.float64), 8)
    levels, places = [Nodes(key, np.bincount(at, times * (1 - bit), len(key)), np.bincount(at, times * bit, len(key)), None)], []
    for d in range(depth - 1, top - 1, -1):
        up, place = levels[-1].parents(d)
        levels.append(up)
        places.append(place)
    return levels, places, at.reshape(-1, 8)


def weighted_tree(counts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(part, key, bits): the code length of each byte string's last byte after its context; from (part, key, n).

    The tree below the two nearest bytes of a context is worked out where all
    its strings are: they share a bucket. Only its topmost nodes (at most 255
    for each pair of bytes) meet in aggregations towards the root, and joins
    bring back what the mixture of the shorter contexts gives to each of them.
    """
    top = min(2, depth)
    near = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * top) - 1))
    dealt = written(counts.withColumn("bucket", F.pmod(F.xxhash64(near), F.lit(buckets))), "lm-tree")

    def upwards(rows: pa.Table) -> pa.Table:
        levels, _, _ = subtree(rows.column("key").to_numpy(), rows.column("n").to_numpy(), depth, top)
        x = levels[-1]
        return pa.table({"bucket": np.full(len(x.key), rows.column("bucket")[0].as_py()), "key": x.key.view(np.int64), "zeros": x.zeros, "ones": x.ones, "ln_w": x.ln_w, "own": x.own})

    shape = "zeros double, ones double, ln_w double"
    crown = written(dealt.groupBy("bucket").applyInArrow(upwards, f"bucket long, key long, {shape}, own double"), "lm-crown")

    # The levels above: one row for each (context, decision).
    levels = [crown.select("key", "zeros", "ones", "ln_w", "own")]
    for d in range(top - 1, -1, -1):
        up = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * d) - 1))
        sums = levels[-1].groupBy(F.shiftleft(up, 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255))).alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("ln_w").alias("below"))

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, zeros, ones, below = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "zeros", "ones", "below"))
                x = Nodes(key, zeros, ones, below)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (key, zeros, ones, x.ln_w, x.own)], names=["key", "zeros", "ones", "ln_w", "own"])

        levels.append(written(sums.mapInArrow(weigh, f"key long, {shape}, own double"), "lm-crown"))
    # Back from the root: what the depths so far give to a one, and the weight left for deeper ones.
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    mixed_so_far = levels[-1].select("key", (F.col("own") * one).alias("p"), (1 - F.col("own")).alias("rest"))
    for d, here in enumerate(reversed(levels[:-1]), 1):
        parent = mixed_so_far.withColumnsRenamed({"key": "up", "p": "p_up", "rest": "rest_up"})
        up = F.shiftleft(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1)), 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
        mixed_so_far = here.withColumn("up", up).join(parent, "up").select("key", (F.col("p_up") + F.col("rest_up") * F.col("own") * one).alias("p"), (F.col("rest_up") * (1 - F.col("own"))).alias("rest"))
    crowned = crown.select("bucket", "key").join(mixed_so_far, "key")

    def downwards(rows: pa.Table, crown: pa.Table) -> pa.Table:
        strings = rows.column("key").to_numpy()
        levels, places, at = subtree(strings, rows.column("n").to_numpy(), depth, top)
        order = np.argsort(crown.column("key").to_numpy().view(np.uint64))
        p, rest = (crown.column(k).to_numpy()[order] for k in ("p", "rest"))
        for x, place in zip(reversed(levels[:-1]), reversed(places)):
            p, rest = p[place] + rest[place] * x.own * x.one, rest[place] * (1 - x.own)
        bit = (strings[:, None] >> (7 - np.arange(8))) & 1
        chance = np.where(bit == 1, p[at], 1 - p[at])
        return pa.table({"part": rows.column("part"), "key": strings, "bits": -np.log2(chance).sum(1)})

    return dealt.groupBy("bucket").cogroup(crowned.groupBy("bucket")).applyInArrow(downwards, "part long, key long, bits double")


def byte_size(setting: str) -> int:
    """A size as Spark's settings have it: 16m, 128MB, 134217728b."""
    digits = setting.lower().rstrip("b").rstrip("kmgt")
    unit = setting.lower().rstrip("b")[len(digits) :]
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, train): what the model and a word-count baseline make of it.

    n_tokens (words and the end), n_known (tokens that training rows have),
    train_tokens, base_score (log10, counts plus one), score (log10 probability
    of the text by the tree), n_bytes and bits_per_byte. The model is that of
    the training rows, whichever row is scored. Null text is empty: its only
    token is the end. Without training rows every bit has probability one half.
    Repeated rows are counted and scored each. Scores don't depend on ``block_bytes``.
    """
    spark = docs.sparkSession
    parts = docs.rdd.getNumPartitions()  # of the scan; nothing runs
    split = byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(1, min(parts, max(2 * spark.sparkContext.defaultParallelism, -(-parts * split // TASK_BYTES))))
    bits = max(4, (4 * tasks - 1).bit_length())
    held = written(in_blocks(docs.coalesce(tasks), depth, bits, block_bytes), "lm-blocks")
    asked = held.where("kind <> 'text'").select("kind", "block", "part", "n", "body", "counts")

    # Words: their counts go straight back to the blocks.
    def word_counts(rows: pa.Table) -> pa.Table:
        keys, total, places = gathered(rows)
        out = answers(rows, keys, total, places)
        sums = pa.table({"kind": ["sums"], "block": pa.array([-1], pa.int64()), "part": pa.array([int((total > 0).sum())], pa.int64()),
                         "n": pa.array([int(total.sum())], pa.int64()), "body": pa.array([None], pa.binary()), "value": pa.array([None], pa.binary())})
        return pa.concat_tables([out.cast(sums.schema), sums])

    words = written(asked.where("kind = 'word'").groupBy("part").applyInArrow(word_counts, ANSWER), "lm-words")
    n, v = words.where("kind = 'sums'").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("part"), F.lit(0))).first()  # two numbers
    less = math.log10(n + v + 1)

    # Strings: their counts make the tree, whose code lengths go back to the blocks.
    def string_counts(rows: pa.Table) -> pa.Table:
        keys, total, _ = gathered(rows)
        return pa.table({"part": np.full(len(keys), rows.column("part")[0].as_py()), "key": keys.view(np.int64), "n": total})

    strung = asked.where("kind = 'string'")
    counts = written(strung.groupBy("part").applyInArrow(string_counts, "part long, key long, n long"), "lm-counts")
    lengths = weighted_tree(counts, depth, 4 * tasks)

    def string_lengths(rows: pa.Table, tree: pa.Table) -> pa.Table:
        keys, _, places = gathered(rows)
        order = np.argsort(tree.column("key").to_numpy().view(np.uint64))
        return answers(rows, keys, tree.column("bits").to_numpy()[order], places)

    codes = strung.groupBy("part").cogroup(lengths.groupBy("part")).applyInArrow(string_lengths, ANSWER)

    schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()), ("bits_per_byte", pa.float64())])

    def judge(texts: pa.Table, answer: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the group before held
        look, kinds, out = {}, np.array(answer.column("kind").to_pylist()), []
        for kind, dtype in (("string", np.float64), ("word", np.int64)):
            at = np.flatnonzero(kinds == kind)
            body, value, n_keys = (answer.column(k).take(pa.array(at)).to_pylist() for k in ("body", "value", "n"))
            keys = np.concatenate([opened(b, m, True) for b, m in zip(body, n_keys)])
            order = np.argsort(keys)
            look[kind] = keys[order], np.concatenate([opened(x, m).view(dtype) for x, m in zip(value, n_keys)])[order]

        def find(kind: str, keys: np.ndarray) -> np.ndarray:
            known, values = look[kind]
            return values[np.searchsorted(known, keys)]

        of_end = int(find("word", np.array([END_TOKEN], np.uint64))[0])
        for k in range(texts.num_rows):
            row = texts.slice(k, 1).to_pylist()[0]
            sym = np.frombuffer(pa.decompress(row["body"], row["n"], "zstd"), np.uint8)
            size = np.array(row["sizes"])
            begin = np.concatenate([[0], np.cumsum(size)])
            code = np.add.reduceat(find("string", strings(sym, begin, depth).view(np.uint64)), begin[:-1])
            w = Words(sym, begin[1:])
            c = find("word", w.hash)
            of = np.repeat(np.arange(len(size)), np.diff(w.of))
            known = np.bincount(of, c > 0, len(size)).astype(np.int64) + (of_end > 0)
            tokens = np.diff(w.of) + 1
            base = np.bincount(of, np.log10(c + 1.0), len(size)) + math.log10(of_end + 1) - tokens * less
            out.append(pa.RecordBatch.from_arrays([
                pa.array(row["ids"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(size), n), pa.int64()),
                pa.array(base), pa.array(-code * math.log10(2)), pa.array(size, pa.int64()), pa.array(code / size)], schema=schema))
        return pa.Table.from_batches(out, schema)

    texts = held.where("kind = 'text'").select("block", "n", "body", "ids", "train", "sizes")
    back = codes.select("block", "kind", "n", "body", "value").union(words.where("kind = 'word'").select("block", "kind", "n", "body", "value"))
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        judge, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double")


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))
    out = score(docs.withColumn("train", train))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")

"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs: at line ends, and after sentences that end with one of a few letters, so that cuts depend on
the words around them alone and a long line has several. The k-th copy of a paragraph in a text has a 40-bit key of its own,
so repeats count. A key is put in one cell in each of three tables; a cell holds how many keys it has, and the exclusive-or of the keys and
of their 16-bit check values. The cells themselves are the fingerprint. The cells of two versions of one size subtract; where sizes
differ, the smaller sketch is made at the larger size (`at_size` does so from a fingerprint alone, by listing its keys). Peeling
takes out, table after table, the keys that stand alone in a cell until none is left: those are the paragraphs that
only one of the two has. Pairs with cells left over are sketched again from their texts with four times the cells, other
hashes and other keys, `RETRIES` times at most; two paragraphs with one key never peel, however many cells there are, so keys change too. What is
then left is counted from the paragraphs' 64-bit digests themselves. Likeness is common paragraphs / (all paragraphs of both - common). Only
DataFrame operations are used.

Scale: documents are ordered by (id descending, null ids last, hash of the text, hash of the other columns) and cut into blocks
of equal counts at exact ranks; at most `MOST_BLOCKS` border keys reach the driver. Texts are shuffled once, by block;
windows, sketches and peeling stay in the task of a block. Each block is given the first document of the next one. Far ids, null ids and
repeated ids fill blocks like others; only rows equal in all columns stay together. Blocks hold `BLOCK_DOCS` documents up to 131 million of
them, and 38,000 at ten thousand million.

Edge cases: null text is empty, which is one empty paragraph; a very long text has as many more cells; equal ids are ordered by the
hash of the text; a table of one document is its own next; an empty table gives no rows; extra columns, maps too, only break ties,
whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import hashable, keep

PARAGRAPH_ENDS = r"[\n ](?<=\n|[a-f][.!?] )"
TABLES = 3
#: Fewest cells in a table, and cells a paragraph (the next power of two is taken).
LEAST_CELLS, CELLS_EACH = 16, 1.5
ROUNDS = 9
#: Sketches of a pair that failed, before its paragraphs are counted.
RETRIES = 3
#: Documents in a block, and blocks at most, whose borders reach the driver (a block has more documents then).
BLOCK_DOCS, MOST_BLOCKS = 500, 1 << 18
#: Documents in a task.
TASK_DOCS = 2000
#: Pairs to try again that may be broadcast (ids and hashes only).
BROADCAST_ROWS = 100_000
_KEY_BITS, _CHECK_BITS = 40, 16
_KEY, _CHECK = (1 << _KEY_BITS) - 1, (1 << _CHECK_BITS) - 1
#: Bits of a packed cell: table and place, count, check value and key.
_PLACE_BITS = 28
CELLS = "array<struct<t:int,c:int,n:int,v:bigint>>"
_ORDER = ["o_null", "o_id", "o_text", "o_rest"]


# Sketches --------------------------------------------------------------------------------------------------------


def digests(text: Column) -> Column:
    """A hash of each paragraph, in order."""
    return F.transform(F.split(text, PARAGRAPH_ENDS), lambda p: F.xxhash64(p))


def cells_for(n: Column) -> Column:
    """Cells in a table for n paragraphs."""
    return F.greatest(F.lit(LEAST_CELLS), F.pow(F.lit(2.0), F.ceil(F.log2(n * CELLS_EACH))).cast("int"))


def _cell(key: Column, table: int | Column, cells: Column, salt: int) -> Column:
    return F.xxhash64(key, F.lit(table) if isinstance(table, int) else table, F.lit(salt)).bitwiseAND(cells - 1).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit("check"), key).bitwiseAND(F.lit(_CHECK))


def _places(key: Column, cells: Column, salt: int) -> Column:
    return F.array(*(F.struct(F.lit(t).alias("t"), _cell(key, t, cells, salt).alias("c")) for t in range(TABLES)))


def _settle(rows: DataFrame, by: list[str]) -> DataFrame:
    """Cells of equal place put together; n: keys of the first text less those of the second."""
    return rows.groupBy(*by, "cells", "t", "c").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("v").alias("v")).where((F.col("n") != 0) | (F.col("v") != 0))


def sketch(entries: DataFrame, by: list[str], salt: int = 0) -> DataFrame:
    """Cells (t, c, n, v) of paragraphs. entries: columns `by`, cells, digest; a row a paragraph."""
    e = entries.groupBy(*by, "cells", "digest").agg(F.count(F.lit(1)).alias("times"))
    e = e.select(*by, "cells", "digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    return place_keys(e.select(*by, "cells", F.lit(1).alias("n"), _key_of(salt).alias("key")), by, salt)


def _key_of(salt: int) -> Column:
    """The key of a paragraph's copy; other salts give other keys."""
    return F.xxhash64("digest", "copy", *([F.lit(salt)] if salt else [])).bitwiseAND(F.lit(_KEY))


def place_keys(keys: DataFrame, by: list[str], salt: int = 0) -> DataFrame:
    """Cells of keys. keys: columns `by`, cells, n, key."""
    k = keys.withColumn("v", F.col("key").bitwiseOR(F.shiftleft(_check(F.col("key")), _KEY_BITS)))
    return _settle(k.select(*by, "cells", "n", "v", F.inline(_places(F.col("key"), F.col("cells"), salt))), by)


def peel(cells: DataFrame, by: list[str], rounds: int = ROUNDS, salt: int = 0, listed: bool = True) -> DataFrame:
    """Recovered keys are rows with t = TABLES, c the key and n its sign; other rows could not be peeled.

    Without `listed` there is one row for all keys of a sketch, n their number."""
    cells = cells.select(*by, "cells", F.col("t").cast("int").alias("t"), F.col("c").cast("long").alias("c"), "n", "v")
    for r in range(rounds):
        table = r % TABLES
        n, v, key = F.col("n"), F.col("v"), F.col("v").bitwiseAND(F.lit(_KEY))
        alone = (F.col("t") == table) & (F.abs("n") == 1) & (F.shiftrightunsigned("v", _KEY_BITS) == _check(key)) & (F.col("c") == _cell(key, table, F.col("cells"), salt))
        cells = cells.withColumn("one", F.when(alone, key).otherwise(F.lit(-1)))
        one = F.col("one")

        def row(t: int | Column, c: Column, n: Column, v: Column) -> Column:
            return F.struct((F.lit(t) if isinstance(t, int) else t).alias("t"), c.cast("long").alias("c"), n.cast("int").alias("n"), v.cast("long").alias("v"))

        out = [row(u, _cell(one, u, F.col("cells"), salt), -n, v) for u in range(TABLES) if u != table]
        out.append(row(TABLES, one, n, F.lit(0)) if listed else row(TABLES, F.lit(0), F.lit(1), F.lit(0)))
        cells = cells.select(*by, "cells", F.inline(F.when(one >= 0, F.array(*out)).otherwise(F.array(row(F.col("t"), F.col("c"), n, v)))))
        cells = _settle(cells, by)
    return cells


def differences(cells: DataFrame, by: list[str]) -> DataFrame:
    """From peeled cells, per pair: differing (paragraphs that only one of the two has) and failed."""
    return cells.groupBy(*by).agg(F.sum(F.when(F.col("t") == TABLES, F.abs("n")).otherwise(0)).alias("differing"), F.max(F.col("t") < TABLES).alias("failed"))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    common = (a + b - differing) / 2
    return common / (a + b - common)


# Fingerprints as strings -----------------------------------------------------------------------------------------


def _packed(t: Column, c: Column, n: Column, v: Column) -> Column:
    """A cell as 26 hexadecimal digits: table and place, count, check value and key."""
    place = F.shiftleft(t.cast("long"), _PLACE_BITS + 16) + F.shiftleft(c.cast("long"), 16) + n
    return F.concat(F.lpad(F.hex(place), 12, "0"), F.lpad(F.hex(v), 14, "0"))


def print_of(cells_each: Column, packed: Column) -> Column:
    """The fingerprint: cells a table, a colon, and the packed cells in base 64."""
    return F.concat(cells_each.cast("string"), F.lit(":"), F.regexp_replace(F.base64(packed), r"\s", ""))


def read_print(fingerprint: Column) -> tuple[Column, Column]:
    """Cells a table, and the cells."""
    size = F.split_part(fingerprint, F.lit(":"), F.lit(1)).cast("int")
    raw = F.hex(F.unbase64(F.split_part(fingerprint, F.lit(":"), F.lit(2))))
    number = lambda i, start, n: F.conv(F.substring(raw, i * 26 + start, F.lit(n)), 16, 10).cast("long")

    def cell(i: Column) -> Column:
        place = number(i, F.lit(1), 8)
        return F.struct(F.shiftright(place, _PLACE_BITS).cast("int").alias("t"), place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int").alias("c"), number(i, F.lit(9), 4).cast("int").alias("n"), number(i, F.lit(13), 14).alias("v"))

    return size, F.transform(F.sequence(F.lit(0), (F.length(raw) / 26).cast("int") - 1), cell).cast(CELLS)


def at_size(prints: DataFrame, by: list[str]) -> DataFrame:
    """Sketches made larger without their texts: all keys are listed by peeling and placed anew. prints: `by`, cells, held, size; cells left over fail."""
    rows = prints.select(*by, "size", "cells", F.inline("held"))
    got = peel(rows, [*by, "size"], 2 * ROUNDS)
    keys = got.where(F.col("t") == TABLES).select(*by, F.col("size").alias("cells"), "n", F.col("c").alias("key"))
    left = got.where(F.col("t") < TABLES).select(*by, F.col("size").alias("cells"), F.lit(0).alias("t"), F.lit(-1).cast("long").alias("c"), F.lit(0).alias("n"), F.lit(1).cast("long").alias("v")).distinct()
    return place_keys(keys, by).unionByName(left)


def compare(pairs: DataFrame, by: list[str]) -> DataFrame:
    """`by`, differing and failed of pairs of fingerprints (columns left, right), from these strings alone."""
    rows = None
    for sign, one, two in ((1, "left", "right"), (-1, "right", "left")):
        (size, held), (other, _) = read_print(F.col(one)), read_print(F.col(two))
        side = pairs.select(*by, size.alias("cells"), held.alias("held"), F.greatest(size, other).alias("size"))
        same = side.where("cells = size").select(*by, "cells", F.inline("held")).withColumn("c", F.col("c").cast("long"))
        each = same.unionByName(at_size(side.where("cells < size"), by)).withColumn("n", F.col("n") * sign)
        rows = each if rows is None else rows.unionByName(each)
    pairs = pairs.select(*by)
    found = differences(peel(_settle(rows, by), by, 2 * ROUNDS, listed=False), by)
    return pairs.join(found, by, "left").select(*by, F.coalesce("differing", F.lit(0)).alias("differing"), F.coalesce("failed", F.lit(False)).alias("failed"))


# Neighbours ------------------------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and the columns that order the documents."""
    others = [hashable(f) for f in docs.schema.fields if f.name not in (id_col, text_col)]
    doc, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    order = {"o_null": doc.isNull().cast("int"), "o_id": F.bitwise_not(F.coalesce(doc.cast("long"), F.lit(0))), "o_text": F.xxhash64(text), "o_rest": F.xxhash64(F.lit(0), *others)}
    return docs.select(doc.alias("id"), text.alias("text"), *(v.alias(k) for k, v in order.items()))


def _borders(base: DataFrame) -> list[tuple[int, ...]]:
    """The keys of the documents at which blocks begin, in order."""
    slim = base.select(*_ORDER)
    each = max(BLOCK_DOCS, -(-slim.count() // MOST_BLOCKS))
    ranked = slim.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return sorted({tuple(r)[: len(_ORDER)] for r in ranked.where(F.col("at") % each == 0).collect()})  # n / each, and one a partition


def _block_of(borders: list[tuple[int, ...]]) -> Column:
    """The last border that is not after a row's key, by bisection."""
    kind = "struct<o_null:int,o_id:bigint,o_text:bigint,o_rest:bigint>"
    held = F.from_json(F.lit(json.dumps([dict(zip(_ORDER, b, strict=True)) for b in borders])), f"array<{kind}>")
    mine = F.struct(*_ORDER)
    steps = [1 << k for k in reversed(range(max(len(borders) - 1, 1).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when((at + step < len(borders)) & (F.get(held, at + step) <= mine), at + step).otherwise(at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the next one in descending id order (after the last: the first): block, row, guest, id, text, next_id, next_text.

    A block's last row is a guest, the first document of the next block."""
    base = _keyed(docs, id_col, text_col)
    borders = _borders(base)
    count = max(len(borders), 1)
    rows = base.withColumn("block", _block_of(borders) if borders else F.lit(0))
    first = docs.sparkSession.createDataFrame([(*b, (k - 1) % count) for k, b in enumerate(borders)], "o_null int, o_id long, o_text long, o_rest long, block int")
    guests = base.join(F.broadcast(first), _ORDER).dropDuplicates(["block"]).withColumn("guest", F.lit(1))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), count * BLOCK_DOCS // TASK_DOCS)
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests).repartition(tasks, "block")
    order = Window.partitionBy("block").orderBy("guest", *_ORDER)
    return both.select("block", F.row_number().over(order).alias("row"), "guest", "id", "text", F.lead("id").over(order).alias("next_id"), F.lead("text").over(order).alias("next_text"))


def edit(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


# The operator ----------------------------------------------------------------------------------------------------


def _sets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the paragraph digests of the text (a) and the edited text (e)."""
    return rows.select(*keys, digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"))


def _entries(sets: DataFrame, by: list[str], kinds: list[tuple[str, Column, Column, Column]]) -> DataFrame:
    """One row a paragraph of each kind (which digests, cells a table, whether at all, uses): `by`, stream, uses, cells, digest."""
    made = F.array(*(F.struct(F.lit(k).alias("stream"), uses.alias("uses"), size.alias("cells"), F.when(when, F.col(held)).alias("held")) for k, (held, size, when, uses) in enumerate(kinds)))
    return sets.select(*by, F.inline(made)).where("held is not null").select(*by, "stream", "uses", "cells", F.explode("held").alias("digest"))


def _sizes(names: str, grow: int = 1) -> dict[str, Column]:
    return {k: cells_for(F.size(k)) * grow for k in names}


#: What a sketch is used for: the pairs with the edited (0) and with the next text (1), on the left (+) or on the right (-).
_USES = {1: (0, 1), 2: (0, -1), 4: (1, 1), 8: (1, -1)}


def _pairs(sets: DataFrame, by: list[str], grow: int = 1, salt: int = 0) -> DataFrame:
    """Cells of the differences of each row's two pairs (its text with the edited and with the next text): `by`, pair, cells, t, c, n, v.

    sets: the paragraph digests a of the text, e of the edited, x of the next text. Every sketch has its own size; the smaller one of a pair is also
    made at the larger size. Sketches are made first and subtracted cell by cell."""
    m = _sizes("aex", grow)
    yes, no = F.lit(True), F.lit(0)
    if_ = lambda when, use: F.when(when, use).otherwise(no)
    kinds = [
        ("a", m["a"], yes, if_(m["e"] <= m["a"], 1) + if_(m["x"] <= m["a"], 4)),
        ("e", m["e"], yes, if_(m["a"] <= m["e"], 2)),
        ("x", m["x"], yes, if_(m["a"] <= m["x"], 8)),
        ("a", m["e"], m["e"] > m["a"], F.lit(1)),
        ("e", m["a"], m["a"] > m["e"], F.lit(2)),
        ("a", m["x"], m["x"] > m["a"], F.lit(4)),
        ("x", m["a"], m["a"] > m["x"], F.lit(8)),
    ]
    one = sketch(_entries(sets, by, kinds).where("uses > 0"), [*by, "uses", "stream"], salt)
    uses = F.filter(F.array(*(F.struct(F.lit(u).alias("use"), F.lit(p).alias("pair"), F.lit(s).alias("sign")) for u, (p, s) in _USES.items())), lambda x: x["use"].bitwiseAND(F.col("uses")) > 0)
    each = one.select(*by, "cells", "t", "c", "n", "v", F.inline(uses))
    return _settle(each.select(*by, "pair", "cells", "t", F.col("c").cast("long").alias("c"), (F.col("n") * F.col("sign")).alias("n"), "v"), [*by, "pair"])


def _prints(sets: DataFrame, by: list[str]) -> DataFrame:
    """`by`, cells_a, cells_e, and the packed cells of a text and its edited text."""
    m = _sizes("ae")
    cells = sketch(_entries(sets, by, [(k, m[k], F.lit(True), F.lit(0)) for k in "ae"]), [*by, "stream"])
    held = lambda k: F.unhex(F.concat_ws("", F.sort_array(F.collect_list(F.when(F.col("stream") == k, F.col("packed"))))))
    size = lambda k: F.max(F.when(F.col("stream") == k, F.col("cells")))
    cells = cells.select(*by, "stream", "cells", _packed(F.col("t"), F.col("c"), F.col("n"), F.col("v")).alias("packed"))
    return cells.groupBy(*by).agg(size(0).alias("cells_a"), size(1).alias("cells_e"), held(0).alias("a"), held(1).alias("e"))


def _differ(difference: DataFrame, by: list[str], rounds: int = ROUNDS, salt: int = 0) -> DataFrame:
    """`by`, differing and failed of both pairs of a row."""
    got = differences(peel(difference, [*by, "pair"], rounds, salt, listed=False), [*by, "pair"])
    pick = lambda k, s, c: F.max(F.when(F.col("pair") == k, F.col(c))).alias(f"{c}_{s}")
    return got.groupBy(*by).agg(*(pick(k, s, c) for k, s in enumerate("ex") for c in ("differing", "failed")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the differing paragraphs found."""
    rows = with_next(docs, id_col, text_col).withColumn("edited", edit(F.col("text"), F.coalesce("next_text", F.lit(""))))
    by = ["block", "row"]
    rows = keep(_sets(rows.withColumns({"n_chars": F.length("text"), "own_hash": F.xxhash64("text"), "next_hash": F.xxhash64("next_text"), "edited_sha256": F.sha2("edited", 256)}), [*by, "guest", "id", "next_id", "n_chars", "own_hash", "next_hash", "edited_sha256"]))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.where("guest = 0").count() // TASK_DOCS)
    sets = rows.select(*by, "guest", "a", "e").repartition(tasks, "block").withColumn("x", F.lead("a").over(Window.partitionBy("block").orderBy("row"))).where("guest = 0")
    found = _differ(_pairs(sets, by), by)
    plain = rows.where("guest = 0").select(*by, "id", "next_id", "n_chars", "own_hash", "next_hash", "edited_sha256", F.size("a").alias("n_a"), F.size("e").alias("n_e"))
    nexts = rows.select("block", (F.col("row") - 1).alias("row"), F.size("a").alias("n_x"))
    out = plain.join(nexts, by).join(_prints(sets, by), by).join(found, by, "left")
    out = keep(out.withColumns({f"differing_{s}": F.coalesce(f"differing_{s}", F.lit(0)) for s in "ex"} | {f"failed_{s}": F.coalesce(f"failed_{s}", F.lit(False)) for s in "ex"}))
    for retry in range(1, RETRIES + 2):
        left = out.where("failed_e or failed_x")
        n = left.count()
        if not n:
            break
        pairs = keep(_pairs_left(docs, left, n, id_col, text_col))
        found = _differ(_pairs(pairs, by, 4**retry, retry), by, 2 * ROUNDS, retry) if retry <= RETRIES else exact(pairs, by)
        better = left.select(*by).join(found, by, "left").select(*by, *(F.coalesce(f"{c}_{s}", F.lit(0) if c == "differing" else F.lit(False)).alias(f"new_{c}_{s}") for s in "ex" for c in ("differing", "failed")))
        better, before = keep(better, pairs), out
        out = out.join(F.broadcast(better) if n <= BROADCAST_ROWS else better, by, "left")
        for s in "ex":
            out = out.withColumn(f"differing_{s}", F.coalesce(f"new_differing_{s}", f"differing_{s}")).withColumn(f"failed_{s}", F.coalesce(f"new_failed_{s}", F.lit(False)))
        out = keep(out.drop(*(f"new_{c}_{s}" for s in "ex" for c in ("differing", "failed"))), before)
    return out.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        print_of(F.col("cells_a"), F.col("a")).alias("fingerprint"),
        print_of(F.col("cells_e"), F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("n_a"), F.col("n_e"), F.col("differing_e")).alias("near_edited"),
        likeness(F.col("n_a"), F.col("n_x"), F.col("differing_x")).alias("near_next"),
        F.col("differing_e").cast("long").alias("n_differing_edited"),
        F.col("differing_x").cast("long").alias("n_differing_next"),
    )


def exact(sets: DataFrame, by: list[str]) -> DataFrame:
    """`by`, differing and failed (never) of both pairs of a row, from the digests: paragraphs of one text less those of the other, counted by digest."""
    sides = F.array(*(F.struct(F.lit(p).alias("pair"), F.lit(n).alias("n"), F.col(c).alias("held")) for p, n, c in ((0, 1, "a"), (0, -1, "e"), (1, 1, "a"), (1, -1, "x"))))
    each = sets.select(*by, F.inline(sides)).select(*by, "pair", "n", F.explode("held").alias("digest"))
    each = each.groupBy(*by, "pair", "digest").agg(F.abs(F.sum("n")).alias("n"))
    total = lambda p: F.coalesce(F.sum(F.when(F.col("pair") == p, F.col("n"))), F.lit(0))
    return each.groupBy(*by).agg(total(0).alias("differing_e"), F.lit(False).alias("failed_e"), total(1).alias("differing_x"), F.lit(False).alias("failed_x"))


def _pairs_left(docs: DataFrame, left: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """block, row and the digests a, e and x of the texts of rows in `left`, edited and next ones too."""
    left = left.select("block", "row", "id", "own_hash", "next_id", "next_hash")
    texts = docs.select(F.col(id_col).alias("k_id"), F.coalesce(F.col(text_col), F.lit("")).alias("k_text")).withColumn("k_hash", F.xxhash64("k_text"))
    want = left.select("id", F.col("own_hash").alias("h")).union(left.select("next_id", "next_hash")).distinct()
    small = F.broadcast if n <= BROADCAST_ROWS else (lambda x: x)
    texts = keep(texts.join(small(want), F.expr("k_id <=> id and k_hash = h"), "left_semi").dropDuplicates(["k_id", "k_hash"]))
    pair = left.join(texts, F.expr("k_id <=> id and k_hash = own_hash")).select("block", "row", "next_id", "next_hash", F.col("k_text").alias("text"))
    pair = pair.join(texts, F.expr("k_id <=> next_id and k_hash = next_hash")).select("block", "row", "text", F.col("k_text").alias("next_text")).withColumn("edited", edit(F.col("text"), F.col("next_text")))
    return _sets(pair, ["block", "row", "next_text"]).withColumn("x", digests(F.col("next_text"))).drop("next_text")

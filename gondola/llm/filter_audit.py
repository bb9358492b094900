"""Filter interaction audit: what each of five text filters removes in every order they can be applied.

A row fails a filter for its own text (A to D) or for an earlier copy of it (E). The failures of a
row are one number, a bit for each filter:

1. One pass over the texts gives A to D and a hash of the text. Only these narrow rows go on.
2. *Existential self-join.* Hashes that several ids share pick the candidates of E. Their rows are
   left-semi joined on hash, exact text and smaller doc_id with one row per text, its smallest id.
   That row is an aggregate with partial minima, so copies never meet in one group; the rows of a hash
   with more than ``SHARE`` copies are dealt to salts, and its one row is repeated for each salt.
3. The ids marked E are united with the ids that fail A to D, their bits are combined by or, and the
   rows are counted by part and combination: 32 counts a part, whatever the size of the corpus.
4. All 120 orders are read off these counts.

A part is a value of ``lang``. Labels count for good_lost and toxic_lost only.

Edge cases: null and empty texts are empty (they fail A; copies of each other fail E); a null id is never
smaller than another, nor has a smaller one; rows of one id and text count each and share their bits;
rows of one id with different texts have their own; a null lang and an empty one are one part; documents
without a label count as neither good nor toxic, an id that has label rows of both kinds counts in either;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import SMALL, written

FILTERS = "ABCDE"
SHARE = 4096
_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}


def own_failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone: A short, B repetitive, C capitals, D symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": n < 100,
        "B": F.lit(100).cast("long") * different < F.lit(80).cast("long") * n,
        "C": F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }
    return sum((F.when(f, _BIT[letter]).otherwise(0) for letter, f in fails.items()), F.lit(0))


def later_copies(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """doc_id, h: distinct rows whose exact text a smaller doc_id has too.

    ``docs`` has doc_id, text and h; ``hashes`` the h that several ids share, with their rows in ``n``.
    """
    hashes = written(hashes.select("h", F.ceil(F.col("n") / SHARE).cast("int").alias("salts")), "audit-hashes")
    few = hashes.count() <= SMALL
    rows = docs.join(F.broadcast(hashes) if few else hashes, "h")
    first = rows.groupBy("h", "text").agg(F.min("doc_id").alias("least"), F.first("salts").alias("salts"))
    first = first.select("h", "text", "least", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    a, b = rows.alias("a"), first.alias("b")
    same = (F.col("a.h") == F.col("b.h")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.text") == F.col("b.text"))
    return a.join(b, same & (F.col("b.least") < F.col("a.doc_id")), "left_semi").select("doc_id", "h").distinct()


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: rows by part and the set of filters they fail."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("h"))
    rows = written(
        docs.select(
            F.col("doc_id").cast("long"),
            F.coalesce("lang", F.lit("")).alias("part"),
            F.xxhash64(text).alias("h"),
            own_failures(text).alias("own"),
        ),
        "audit-rows",
    )
    ids = F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")
    copies = later_copies(texts, rows.groupBy("h").agg(*ids).where("least < most"))
    failing = rows.where("own > 0").select("doc_id", "h", "own").unionByName(copies.withColumn("own", F.lit(_BIT["E"])))
    bits = failing.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("k")).agg(F.bit_or("own").alias("bits"))
    marked = rows.join(bits, (F.col("h") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = marked.join(known, F.col("doc_id") == F.col("label_id"), "left")
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)
    return marked.groupBy("part", F.coalesce("bits", F.lit(0)).alias("bits")).agg(
        F.count("*").alias("n"), total("good"), total("toxic")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, zeros included: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost (all at this step) and shapley (removed by its filter over all orders)."""
    counts = written(combinations(docs, labels), "audit-counts")
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    bit = F.element_at(F.create_map(*(F.lit(x) for pair in _BIT.items() for x in pair)), letter)
    before = sum(
        (F.when(F.instr("filter_order", x) < F.col("step"), b).otherwise(0) for x, b in _BIT.items()), F.lit(0)
    )
    steps = steps.withColumns({"letter": letter, "bit": bit, "before": before})
    bits = F.col("bits")
    fails, gone = bits.bitwiseAND(F.col("bit")) != 0, bits.bitwiseAND(F.col("before")) != 0
    removed = fails & ~gone
    where = lambda cond, name: F.sum(F.when(cond, F.col(name)).otherwise(0)).cast("long")
    found = steps.groupBy("part", "filter_order", "step", "letter").agg(
        where(~fails & ~gone, "n").alias("kept"),
        where(removed, "n").alias("removed"),
        where(fails & gone, "n").alias("redundant"),
        where(bits == F.col("bit"), "n").alias("unique_fails"),
        where(removed, "good").alias("good_lost"),
        where(removed, "toxic").alias("toxic_lost"),
    )
    shapley = found.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return found.join(shapley, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


# The same counts in DuckDB: rows, bits and orders by joins of small tables.
ORACLE = r"""
WITH w AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), b AS (
    SELECT w.doc_id, part,
           (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS bits
    FROM w
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), c AS (
    SELECT part, bits, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM b LEFT JOIN l ON b.doc_id = l.doc_id GROUP BY part, bits
), f(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
    SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order
    FROM f f1 JOIN f f2 ON f2.x <> f1.x JOIN f f3 ON f3.x NOT IN (f1.x, f2.x)
    JOIN f f4 ON f4.x NOT IN (f1.x, f2.x, f3.x) JOIN f f5 ON f5.x NOT IN (f1.x, f2.x, f3.x, f4.x)
), s AS (
    SELECT filter_order, instr(filter_order, f.x) AS step, f.x, f.bit,
           (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE instr(filter_order, g.x) < instr(filter_order, f.x)) AS earlier
    FROM o, f
), r AS (
    SELECT part, filter_order, step, x,
           sum(CASE WHEN bits & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN bits & bit <> 0 AND bits & earlier <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, (SELECT filter_order, step, x, bit::BIGINT AS bit, earlier::BIGINT AS earlier FROM s)
    GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
"""

"""Operator 12: I-Match fingerprints over randomised subsets of a lexicon.

A term is in the lexicon if its inverse document frequency lies between ln ``COMMON`` and
ln ``RARE``.  The sorted distinct lexicon terms of a text are hashed once for each of 64
random subsets of the lexicon.  Subsets come in four levels that keep every 16th, 64th,
256th and 1024th term, so texts of any length have subsets that hold a few of their terms:
there the chance that two texts agree is close to the share of terms that they have in
common.

Everything is made of built-in expressions.  At most ``RARE`` times the mean number of
distinct terms of a text can be in so many documents as the band asks for, however many
documents there are, so the lexicon goes to the tasks as a scalar subquery: an array of
hash buckets, in which a term is looked up in constant time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import let, table
from tierflow.sources.scratch import staged

#: A term is a run of characters other than these; a run of these parts terms.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = "[^" + APART[1:]
#: Terms in more than one of ``COMMON`` documents, or in fewer than one of ``RARE``, are out.
COMMON, RARE = 8, 512
#: A subset of level i keeps one term of 2 ** BITS[i]; every level has ``EACH`` subsets.
BITS, EACH = (4, 6, 8, 10), 16
SLOTS = 1 << 16


def terms(text: Column) -> Column:
    """Distinct terms of a text in lower case (splitting costs a sixth of matching each term)."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), APART)), "")


def _mask(term: Column) -> Column:
    """Bit ``EACH`` * level + i says whether the term is in subset i of the level."""
    bits = []
    for level, width in enumerate(BITS):
        drawn = F.sha2(F.concat(F.lit(str(level)), term), 256)
        for i in range(EACH):
            part = F.conv(F.substring(drawn, 4 * i + 1, 4), 16, 10).cast("int")
            bit = 1 << (EACH * level + i)
            bits.append(F.when(part % (1 << width) == 0, F.lit(bit - (bit >> 63 << 64))).otherwise(F.lit(0)))
    mask = bits[0].cast("long")
    for b in bits[1:]:
        mask = mask.bitwiseOR(b.cast("long"))
    return mask


def lexicon(
    documents: DataFrame, text: str = "text", *, common: int = COMMON, rare: int = RARE,
) -> DataFrame:
    """(term, df, mask) of all terms in the band, counted over all documents."""
    n = documents.agg(F.count(F.lit(1)).alias("n"))
    counted = (
        documents.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    )
    band = counted.where((F.col("df") * common <= n.scalar()) & (F.col("df") * rare >= n.scalar()))
    return band.select("term", "df", _mask(F.col("term")).alias("mask"))


def _slot(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(SLOTS)).cast("int")


def _by_slot(words: DataFrame) -> DataFrame:
    """The lexicon as one row: an array by slot of arrays of (term, mask)."""
    held = words.groupBy(_slot(F.col("term")).alias("id")).agg(
        F.collect_list(F.struct("term", "mask")).alias("held")
    )
    empty = F.array().cast("array<struct<term:string,mask:bigint>>")
    every = words.sparkSession.range(SLOTS).select(F.col("id").cast("int")).join(held, "id", "left")
    return every.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("id", F.coalesce("held", empty).alias("held")))),
            lambda s: s["held"],
        ).alias("slots")
    )


def parts(text: Column, slots: Column) -> Column:
    """One hash for each subset, NULL for subsets that hold no term of the text."""

    def known(term: Column) -> Column:
        held = F.element_at(slots, _slot(term) + 1)
        return F.get(F.filter(held, lambda x: x["term"] == term), F.lit(0))

    found = F.array_sort(
        F.filter(F.transform(terms(text), known), lambda x: x.isNotNull() & (x["mask"] != 0))
    )

    def hashed(own: Column, bit: Column) -> Column:
        inside = F.filter(
            own, lambda x: F.call_function("shiftright", x["mask"], bit).bitwiseAND(F.lit(1)) == 1
        )
        joined = F.array_join(F.transform(inside, lambda x: x["term"]), " ")
        return let(joined, lambda j: F.when(j != "", F.substring(F.md5(j), 1, 8)))

    def of_level(own: Column, i: Column) -> Column:
        start = (i * EACH).cast("int")
        some = F.filter(own, lambda x: F.call_function("shiftright", x["mask"], start).bitwiseAND(F.lit((1 << EACH) - 1)) != 0)
        bits = F.sequence(start, start + (EACH - 1))
        return let(some, lambda held: F.transform(bits, lambda bit: hashed(held, bit)))

    def of_levels(own: Column) -> Column:
        levels = F.sequence(F.lit(0), F.lit(len(BITS) - 1))
        return F.flatten(F.transform(levels, lambda i: of_level(own, i)))

    return let(found, of_levels)


def fingerprint(hashes: Column, text: Column) -> Column:
    """The hashes as text; a text without any has a hash of all its distinct terms."""
    whole = F.concat(F.lit("="), F.md5(F.array_join(F.array_sort(terms(text)), " ")))
    return F.when(
        F.exists(hashes, lambda h: h.isNotNull()), F.array_join(hashes, ",", "")
    ).otherwise(whole)


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: 1 if equal, else the share of equal hashes among all that either has."""
    def share(x: Column, y: Column) -> Column:
        either = F.zip_with(x, y, lambda p, q: F.when(p == q, F.when(p != "", 1.0)).otherwise(F.lit(0.0)))
        return F.aggregate(
            F.filter(either, lambda v: v.isNotNull()), F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
            lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")),
            lambda acc: acc["s"] / acc["n"],
        )

    plain = a.startswith("=") | b.startswith("=")
    return F.when(a == b, 1.0).when(plain, 0.0).otherwise(share(F.split(a, ","), F.split(b, ",")))


def _ranges(rows: DataFrame, ranges: int) -> list[int]:
    """Upper ends of ranges of ids with about as many rows each; the last is the highest id."""
    steps = [i / ranges for i in range(1, ranges + 1)]
    ends = rows.agg(F.percentile_approx("doc_id", steps, max(10_000, 4 * ranges)).alias("e"), F.max("doc_id").alias("m")).first()
    return sorted({*(ends["e"] or []), *([] if ends["m"] is None else [ends["m"]])})


def _range_of(doc_id: Column, ends: list[int]) -> Column:
    """How many ends lie below the id, by two steps; 0 for a NULL id."""
    width = max(1, math.isqrt(len(ends)))
    heads = F.array(*[F.lit(e).cast("long") for e in ends[width - 1 :: width]])
    fine = F.array(*[F.lit(e).cast("long") for e in ends])

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda e: e < doc_id))

    return F.when(doc_id.isNull(), 0).otherwise(
        let(below(heads) * width, lambda start: start + below(F.slice(fine, start + 1, F.lit(width))))
    )


def with_next(documents: DataFrame, ranges: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(range, place, ghost, doc_id, text, next): rows in descending order of ids, and the text after each.

    NULL ids come last; equal ids are in the order of their texts' hashes and texts.  Ids are
    cut into ranges whose upper ends are ids, so the row that opens a range is known by its
    id, and a copy (``ghost``) of it closes the range above; the very first row closes the
    lowest range.  One shuffle places all rows.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ends = _ranges(rows, ranges)
    if ends:
        at = _range_of(F.col("doc_id"), ends)
        own = F.array(*[F.lit(e).cast("long") for e in ends])
        opens = F.col("doc_id") == F.element_at(own, F.col("_at") + 1)
        after = F.when(F.col("_at") + 1 < len(ends), F.col("_at") + 1).otherwise(0)
        own_place = F.struct(F.col("_at").alias("range"), F.lit(0).alias("ghost"))
        places = F.when(
            F.coalesce(opens, F.lit(False)),
            F.array(own_place, F.struct(after.alias("range"), F.lit(1).alias("ghost"))),
        ).otherwise(F.array(own_place))
        placed = rows.withColumn("_at", at).select(F.inline(places), "doc_id", "text")
    else:
        placed = rows.select(F.lit(0).alias("range"), F.lit(0).alias("ghost"), "doc_id", "text")
    order = Window.partitionBy("range").orderBy(
        "ghost", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text"
    )
    # Without any id there is one range and no ghost: the row after the last is the first.
    following = F.coalesce(F.lead("text").over(order), F.first("text").over(order))
    return placed.select(
        "range", F.row_number().over(order).alias("place"), "ghost", "doc_id", "text",
        following.alias("next"),
    )


def fingerprinted(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
    common: int = COMMON, rare: int = RARE, ranges: int | None = None,
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text has the last half of the code points replaced by the first as many of
    the next document in descending order of ids (of the first, after the last).

    NULL texts are empty; NULL ids come last; repeated rows are documents of their own, in
    any order among themselves, as they are alike; a lone document is its own next; an empty
    table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = staged(lexicon(documents, text, common=common, rare=rare), "lexicon")
    length = F.length("text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - F.floor(length / 2).cast("int")),
        F.substring(F.col("next"), F.lit(1), F.floor(length / 2).cast("int")),
    )

    def made(slots: Column) -> Column:
        return let(
            edited,
            lambda e: F.struct(
                F.sha2(e, 256).alias("edited_sha256"),
                let(parts(F.col("text"), slots), lambda p: fingerprint(p, F.col("text"))).alias("fingerprint"),
                let(parts(e, slots), lambda p: fingerprint(p, e)).alias("edited_fingerprint"),
            ),
        )

    # The subquery is named once, so that it moves into the projection and into no row.
    marked = (
        with_next(documents, ranges, doc_id, text)
        .withColumn("_slots", _by_slot(words).scalar())
        .select("range", "place", "ghost", "doc_id", length.cast("long").alias("n_chars"), let(F.col("_slots"), made).alias("_made"))
    )
    order = Window.partitionBy("range").orderBy("place")
    after = F.coalesce(F.lead("_made.fingerprint").over(order), F.first("_made.fingerprint").over(order))
    compared = marked.withColumn("_next", after).where("ghost = 0")
    return compared.select("doc_id", "n_chars", "_made.*", "_next").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))


ORACLE = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
 e as (
  select *, length(text) as n,
    coalesce(lead(text) over o, first_value(text) over (o rows between unbounded preceding and unbounded following)) as nx
  from d window o as (order by doc_id desc)
 ),
 x as (select doc_id, n, text, left(text, n - n // 2) || left(nx, n // 2) as edited, nx from e),
 t as (
  select doc_id, 0 as side, unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) as term from x
  union all
  select doc_id, 1, unnest(list_distinct(regexp_extract_all(lower(edited), '{TERM}'))) from x
 ),
 lex as (
  select term from t where side = 0 group by term
  having count(*) * {COMMON} <= (select count(*) from d) and count(*) * {RARE} >= (select count(*) from d)
 ),
 s as (select range as k, range // {EACH} as level, range % {EACH} as i from range({len(BITS) * EACH})),
 member as (
  select term, k from lex, s
  where cast('0x' || substr(sha256(level || term), cast(4 * i + 1 as int), 4) as int) % (16 << (2 * level)::int) = 0
 ),
 h as (
  select doc_id, side, k, left(md5(string_agg(term, ' ' order by term)), 8) as h
  from t join member using (term) group by doc_id, side, k
 ),
 f as (select doc_id, side, list(h order by k) as hs, list(k order by k) as ks from h group by doc_id, side),
 w as (select doc_id, side, '=' || md5(string_agg(term, ' ' order by term)) as whole from t group by doc_id, side),
 p as (
  select x.doc_id, v.side,
    case when ks is not null
     then array_to_string(list_transform(range({len(BITS) * EACH}), lambda k: coalesce(hs[list_position(ks, k)], '')), ',')
     else coalesce(whole, '=' || md5('')) end as fp
  from x cross join (values (0), (1)) v(side) left join f using (doc_id, side) left join w using (doc_id, side)
 ),
 a as (
  select x.doc_id, x.n, x.edited, p.fp, q.fp as efp,
    coalesce(lead(p.fp) over o, first_value(p.fp) over (o rows between unbounded preceding and unbounded following)) as nfp
  from x join p on p.doc_id = x.doc_id and p.side = 0 join p q on q.doc_id = x.doc_id and q.side = 1
  window o as (order by x.doc_id desc)
 ),
 l as (
  select *,
    list_filter(list_zip(string_split(fp, ','), string_split(efp, ',')), lambda z: z[1] <> '' or z[2] <> '') as ze,
    list_filter(list_zip(string_split(fp, ','), string_split(nfp, ',')), lambda z: z[1] <> '' or z[2] <> '') as zn
  from a
 )
select doc_id, n as n_chars, sha256(edited) as edited_sha256, fp as fingerprint, efp as edited_fingerprint,
  case when fp = efp then 1.0 when fp like '=%' or efp like '=%' then 0.0
   else len(list_filter(ze, lambda z: z[1] = z[2])) / len(ze) end::double as near_edited,
  case when fp = nfp then 1.0 when fp like '=%' or nfp like '=%' then 0.0
   else len(list_filter(zn, lambda z: z[1] = z[2])) / len(zn) end::double as near_next
from l
"""

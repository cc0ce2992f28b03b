"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraph digests.

A sketch has three subtables. Every distinct paragraph digest is added to one cell of each: the cell counts it, XORs the
digest and XORs a checksum of it. Subtracting two sketches cancels what both documents hold. A cell left with a count of
plus or minus one and a matching checksum is pure: it names a differing digest and the side that holds it, and is then
taken out of its cells in the other subtables, where it may leave new pure cells. Peeling one subtable at a time, every
digest is found once.

The fingerprint of a document is such a sketch of a fixed number of cells. Two fingerprints are subtracted and peeled in
one row, without a shuffle. Pairs that differ by more than the cells can name are tried again with sketches sized for both
sets, as rows of touched cells partitioned by pair, and then with twice as many cells until all digests are recovered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let
from tidemark.operators.numbering import number_rows
from tidemark.session import materialise

# Paragraphs are lines, cut at every sentence end.
PARAGRAPH_END = r"\n+|(?<=[.!?])\s+|(?<=[\x{3002}\x{FF01}\x{FF1F}])\s*"
# What is still longer than this many bytes is cut at borders that its bytes select, so in any script: in hexadecimal,
# after three bytes whose last two bits are 1, 2, 3 in this order, with 32 bytes at least and 512 at most in a piece.
LONG_BYTES = 256
BYTE_PIECE = "(?:..){32,509}?(?:.[159D].[26AE].[37BF])|(?:..){1,512}"
SUBTABLES = 3
CYCLES = 4
# A retry has three cells per digest and more, so two cycles empty nearly all of its sketches.
RETRY_CYCLES = 2
# Cells per subtable of a fingerprint.
CELLS = 8
# Digests that one task of a retry should hold.
TASK_DIGESTS = 500_000
PAIR, CELL = ["uid", "kind"], ["uid", "kind", "subtable", "place"]
DIFFERING = "array<struct<digest:bigint,sign:bigint>>"


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text as hexadecimal UTF-8, long ones in pieces; empty paragraphs do not count."""
    parts = F.transform(F.filter(F.split(text, PARAGRAPH_END), lambda p: p != ""), F.hex)
    pieces = lambda p: F.regexp_extract_all(p, F.lit(BYTE_PIECE), F.lit(0))
    return F.flatten(F.transform(parts, lambda p: F.when(F.length(p) > 2 * LONG_BYTES, pieces(p)).otherwise(F.array(p))))


def digests(text: Column) -> Column:
    """Distinct 48-bit digests of the paragraphs of a text; only those of two documents are ever compared."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p).bitwiseAND(F.lit((1 << 48) - 1))))


def checksum(digest: Column) -> Column:
    """32 bits of another hash. A wrong digest that passes leaves cells that are not empty, so the pair is tried again."""
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit((1 << 32) - 1))


def place(digest: Column, subtable, cells, attempt) -> Column:
    """The cell of a digest in one subtable."""
    return F.pmod(F.xxhash64(digest, F.lit(subtable) if isinstance(subtable, int) else subtable, attempt), cells)


def spot(digest: Column, subtable: int) -> Column:
    """The cell of a digest in a fingerprint, counted through all subtables."""
    return (place(digest, subtable, F.lit(CELLS), F.lit(0)) + subtable * CELLS).cast("int")


def cell(n: Column, keys: Column, checks: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), keys.alias("keys"), checks.alias("checks"))


def no_cell() -> Column:
    return cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))


def add(held: Column, other: Column, sign: Column | int) -> Column:
    """A cell with ``sign`` times another added."""
    return cell(
        held["n"] + sign * other["n"],
        held["keys"].bitwiseXOR(other["keys"]),
        held["checks"].bitwiseXOR(other["checks"]),
    )


def sketch(found: Column) -> Column:
    """The fingerprint of a set of digests: SUBTABLES x CELLS cells with count, key and checksum."""
    spots = lambda d: F.array(*[spot(d, s) for s in range(SUBTABLES)])
    entries = F.transform(
        found, lambda d: F.struct(cell(F.lit(1), d, checksum(d)).alias("one"), spots(d).alias("spots"))
    )

    def filled(entries: Column, at: int) -> Column:
        mine = lambda h, e: F.when(e["spots"][at // CELLS] == at, add(h, e["one"], 1)).otherwise(h)
        return F.aggregate(entries, no_cell(), mine)

    return let(entries, lambda e: F.array(*[filled(e, at) for at in range(SUBTABLES * CELLS)]))


def written(cells: Column) -> Column:
    """A fingerprint as text: the cells in order, as count, key and checksum in hexadecimal; an empty cell is empty."""
    number = lambda c, digits: F.lpad(F.hex(c), digits, "0")
    one = lambda c: F.concat(c["n"].cast("string"), F.lit("."), number(c["keys"], 12), number(c["checks"], 8))
    empty = lambda c: (c["n"] == 0) & (c["keys"] == 0) & (c["checks"] == 0)
    return F.array_join(F.transform(cells, lambda c: F.when(empty(c), F.lit("")).otherwise(one(c))), ":")


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: add(a, b, -1))


def peeled(cells: Column) -> Column:
    """(cells, found): what is left of a difference of fingerprints, and the digests recovered from it with their sign.

    One subtable is peeled per step, so a digest that is pure in several cells is found once.
    """
    pure = lambda c: (F.abs(c["n"]) == 1) & (checksum(c["keys"]) == c["checks"])

    def step(state: Column, subtable: Column) -> Column:
        mine = F.slice(state["cells"], subtable * CELLS + 1, CELLS)

        def without(found: Column) -> Column:
            spots = F.transform(
                found, lambda c: F.struct(c.alias("c"), F.array(*[spot(c["keys"], s) for s in range(SUBTABLES)]).alias("at"))
            )
            gone = lambda h, x, i: F.when(F.array_contains(x["at"], i), add(h, x["c"], -1)).otherwise(h)
            taken = let(spots, lambda xs: F.transform(
                state["cells"], lambda c, i: F.aggregate(xs, c, lambda h, x: gone(h, x, i))
            ))
            named = F.transform(found, lambda c: F.struct(c["keys"].alias("digest"), c["n"].alias("sign")))
            return F.struct(taken.alias("cells"), F.concat(state["found"], named).alias("found"))

        return let(F.filter(mine, pure), lambda found: F.when(F.size(found) == 0, state).otherwise(without(found)))

    steps = F.array(*[F.lit(s) for _ in range(CYCLES) for s in range(SUBTABLES)])
    start = F.struct(cells.alias("cells"), F.array().cast(DIFFERING).alias("found"))
    return F.aggregate(steps, start, step)


def difference(left: Column, right: Column) -> Column:
    """The digests in which two fingerprints differ, +1 on the left and -1 on the right; NULL if they name not all."""
    apart = F.aggregate(left, F.lit(0).cast("long"), lambda n, c: n + c["n"]) - F.aggregate(
        right, F.lit(0).cast("long"), lambda n, c: n + c["n"]
    )
    left_over = lambda c: (c["n"] != 0) | (c["keys"] != 0) | (c["checks"] != 0)
    whole = let(peeled(subtract(left, right)), lambda p: F.when(~F.exists(p["cells"], left_over), p["found"]))
    # A digest counts in one cell of every subtable. More differing digests than cells can never be named.
    return F.when(F.abs(apart) <= SUBTABLES * SUBTABLES * CELLS, whole)


def touched_cells(pairs: DataFrame, attempt: int) -> DataFrame:
    """(uid, kind, subtable, place, n, keys, checks, cells): the difference of both sketches of every pair.

    ``cells`` per subtable is the smallest power of two that is not below the digests of both sides, doubled with every
    attempt after the first. Cells that cancelled are left out.
    """
    total = F.size("left_digests") + F.size("right_digests")
    cells = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(total, F.lit(2)).cast("double"))) + attempt - 1).cast("long")

    def signed(side: str, sign: int) -> Column:
        return F.transform(side, lambda d: F.struct(d.alias("digest"), F.lit(sign).alias("sign")))

    entries = F.explode(F.concat(signed("left_digests", 1), signed("right_digests", -1)))
    rows = pairs.select(*PAIR, cells.alias("cells"), entries.alias("entry")).select(*PAIR, "cells", "entry.*")
    subtable = F.explode(F.array(*[F.lit(s) for s in range(SUBTABLES)])).alias("subtable")
    spread = rows.select(*PAIR, "cells", "digest", "sign", subtable)
    return summed(
        spread.select(
            *CELL[:-1],
            place(F.col("digest"), F.col("subtable"), F.col("cells"), F.lit(attempt)).alias("place"),
            F.col("sign").cast("long").alias("n"),
            F.col("digest").alias("keys"),
            checksum(F.col("digest")).alias("checks"),
            "cells",
        )
    )


def summed(cells: DataFrame) -> DataFrame:
    """One row per cell that is not empty. Rows of subtable -1 are recovered digests, their place is the digest."""
    added = cells.groupBy(*CELL).agg(
        F.sum("n").alias("n"), F.bit_xor("keys").alias("keys"), F.bit_xor("checks").alias("checks"),
        F.max("cells").alias("cells"),
    )
    return added.where("n <> 0 OR keys <> 0 OR checks <> 0")


def peel(cells: DataFrame, subtable: int, attempt: int) -> DataFrame:
    """Take the digests of the pure cells of one subtable out of all cells and keep them with their sign."""
    pure = (F.col("subtable") == subtable) & (F.abs("n") == 1) & (checksum(F.col("keys")) == F.col("checks"))

    def row(s: int, at: Column, n: Column) -> Column:
        return F.struct(
            F.lit(s).alias("subtable"), at.alias("place"), n.alias("n"), F.col("keys").alias("keys"),
            F.col("checks").alias("checks"),
        )

    recovered = row(-1, F.col("keys"), F.col("n"))
    others = [
        row(s, place(F.col("keys"), s, F.col("cells"), F.lit(attempt)), -F.col("n"))
        for s in range(SUBTABLES) if s != subtable
    ]
    same = F.struct("subtable", "place", "n", "keys", "checks")
    after = F.explode(F.when(pure, F.array(recovered, *others)).otherwise(F.array(same))).alias("c")
    return summed(cells.select(*PAIR, "cells", after).select(*PAIR, "cells", "c.*"))


def recovered_by_retry(sets: DataFrame, aggregates: list[Column]) -> DataFrame:
    """(uid, kind, aggregates): ``aggregates`` over ``digest`` and ``sign`` of all digests in which each pair differs.

    ``sets`` has the columns uid, left_digests and rights, an array of digest arrays with NULL for what need not be
    compared; ``kind`` is the place in it. Every attempt doubles the sketches of the pairs that the one before left
    unfinished, until none is left. The sets are shuffled by uid once per attempt, and every round of peeling stays in
    that partitioning. A pair that does not differ has no row.
    """
    spark = sets.sparkSession
    size = F.size("left_digests") + F.aggregate("rights", F.lit(0), lambda n, r: n + F.coalesce(F.size(r), F.lit(0)))
    total = sets.agg(F.sum(size)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_DIGESTS))
    done, failed, attempt = None, None, 1
    while True:
        rest = sets if failed is None else sets.join(failed.select("uid").distinct(), "uid", "left_semi")
        pairs = rest.repartition(parts, "uid").select(
            "uid", "left_digests", F.posexplode("rights").alias("kind", "right_digests")
        )
        pairs = pairs.where(F.col("right_digests").isNotNull())
        if failed is not None:
            pairs = pairs.join(failed, PAIR, "left_semi")
        cells = touched_cells(pairs, attempt)
        for _ in range(RETRY_CYCLES):
            for subtable in range(SUBTABLES):
                cells = peel(cells, subtable, attempt)
        named = cells.withColumns({"digest": F.when(F.col("subtable") == -1, F.col("keys")), "sign": F.col("n")})
        left = F.count_if(F.col("subtable") >= 0) > 0
        tried = materialise(
            named.groupBy(*PAIR).agg(*aggregates, left.alias("unfinished")), "sketch-attempt"
        )
        whole = tried.where("NOT unfinished").drop("unfinished")
        done = whole if done is None else done.unionByName(whole)
        failed, attempt = tried.where("unfinished").select(*PAIR), attempt + 1
        if failed.isEmpty():
            return done


def differing_digests(sets: DataFrame) -> DataFrame:
    """(uid, kind, differing): the digests in which sets differ, with +1 for the left side and -1 for the right.

    ``sets`` has the columns uid, left_digests and rights, an array of digest arrays; ``kind`` is the place in it. Pairs
    that do not differ have an empty list. Fingerprints are subtracted first; what they cannot name is tried again with
    larger sketches.
    """
    small = let(sketch(F.col("left_digests")), lambda own: F.transform(
        "rights", lambda r: difference(own, sketch(r))
    ))
    named = materialise(sets.withColumn("named", small), "sketch-differences")
    pairs = named.select("uid", F.posexplode("named").alias("kind", "differing"))
    entry = F.when(F.col("digest").isNotNull(), F.struct("digest", "sign"))
    more = recovered_by_retry(
        open_sets(named, "named"), [F.collect_list(entry).cast(DIFFERING).alias("more")]
    )
    both = pairs.join(more, PAIR, "left")
    return both.select(*PAIR, F.coalesce("differing", "more", F.array().cast(DIFFERING)).alias("differing"))


def open_sets(sets: DataFrame, named: str) -> DataFrame:
    """The pairs that fingerprints alone could not tell apart, as input of the retry."""
    rights = F.zip_with("rights", named, lambda r, d: F.when(d.isNull(), r))
    return sets.where(F.exists(named, lambda d: d.isNull())).select("uid", "left_digests", rights.alias("rights"))


def likeness(n_left: Column, n_right: Column, n_differing: Column) -> Column:
    """Common digests over all digests; two documents without paragraphs are alike."""
    total = n_left + n_right
    return F.when(total == 0, F.lit(1.0)).otherwise((total - n_differing) / (total + n_differing))


def next_documents(docs: DataFrame, key: str) -> DataFrame:
    """(key, next_key, text_hash, longest): the next smaller key of every key, after the smallest the largest.

    ``text_hash`` picks the text that stands for the next key if that has several rows; ``longest`` is the size of the
    longest text of the key. NULL is the smallest key.
    """
    ids = docs.groupBy(F.col("_key")).agg(F.min(F.xxhash64("_text")).alias("text_hash"), F.max("n_chars").alias("longest"))
    numbered = materialise(number_rows(ids, ["_key"], "_n"), "next-documents")
    last = numbered.count()
    follows = F.when(F.col("_n") > 1, F.col("_n") - 1).otherwise(F.lit(last).cast("long"))
    after = numbered.select(F.col("_n").alias("_m"), F.col("_key").alias("next_key"), "text_hash")
    return numbered.select(F.col("_key").alias("for_key"), "longest", follows.alias("_m")).join(after, "_m").drop("_m")


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and the likeness to the edited and to the next text.

    The edited text is the text with its second half replaced by the start of the next document. NULL texts are empty.
    Rows that share a key have the same next key; repeated rows each give a row; one row alone is its own next. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    read = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sized = read.withColumn("n_chars", F.length("_text").cast("long"))
    order = next_documents(sized, key)
    many = sized.count() > order.count()
    half = F.floor(F.col("n_chars") / 2).cast("int")

    followed = order.withColumnRenamed("text_hash", "_hash")
    # The text side of both joins is one shuffle: the same columns, partitioned by the same key.
    same = F.col("_key").eqNullSafe(F.col("next_key"))
    stands = F.xxhash64("_text").bitwiseXOR(F.col("_hash")) == 0  # written so that it is no key of the join
    heads = (
        read.join(followed, same)
        .where(stands)
        .select(
            "for_key",
            F.expr("substring(_text, 1, cast(longest div 2 as int))").alias("head"),
            digests(F.col("_text")).alias("next_digests"),
        )
    )
    if many:
        heads = heads.dropDuplicates(["for_key"])
    kept = "substring(_text, 1, cast(n_chars - n_chars div 2 as int))"
    joined = (
        read.join(heads, F.col("_key").eqNullSafe(F.col("for_key")), "left")
        .withColumn("n_chars", F.length("_text").cast("long"))
        .withColumn("edited", F.concat(F.expr(kept), F.substring("head", 1, half)))
    )
    sets = joined.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("_key").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("_text")).alias("left_digests"),
        F.array(digests(F.col("edited")), F.col("next_digests")).alias("rights"),
    )
    prints = sets.withColumns({
        "own": sketch(F.col("left_digests")), "others": F.transform("rights", sketch),
    }).withColumn("named", F.transform("others", lambda other: difference(F.col("own"), other)))
    counted = F.transform("named", lambda d: F.when(d.isNotNull(), F.size(d)))  # NULL where the retry has to tell
    whole = materialise(
        prints.select(
            "uid", "doc_id", "n_chars", "edited_sha256",
            written(F.col("own")).alias("fingerprint"),
            written(F.col("others")[0]).alias("edited_fingerprint"),
            *[F.size(c).alias(f"_n{i}") for i, c in enumerate(
                [F.col("left_digests"), F.col("rights")[0], F.col("rights")[1]]
            )],
            counted.alias("counted"),
            F.when(F.exists("named", lambda d: d.isNull()), F.col("left_digests")).alias("left_digests"),
            F.zip_with("rights", "named", lambda r, d: F.when(d.isNull(), r)).alias("rights"),
        ),
        "fingerprints",
    )
    open_pairs = whole.where(F.col("left_digests").isNotNull()).select("uid", "left_digests", "rights")
    tried = recovered_by_retry(open_pairs, [F.count("digest").alias("n_differing")])
    differing = tried.groupBy("uid").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n_differing"))).alias("_edited"),
        F.max(F.when(F.col("kind") == 1, F.col("n_differing"))).alias("_next"),
    )
    shown_rows = whole.drop("left_digests", "rights").join(differing, "uid", "left")
    nothing = F.lit(0)
    return shown_rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("_n0"), F.col("_n1"), F.coalesce(F.col("counted")[0], "_edited", nothing)).alias("near_edited"),
        likeness(F.col("_n0"), F.col("_n2"), F.coalesce(F.col("counted")[1], "_next", nothing)).alias("near_next"),
    )

"""Item co-occurrence recommender (A1-A3, A5, P5-P9) as DataFrame plans.

Input is a DataFrame of view events ``(user, item)``. A user's *basket* is the
set of distinct items they viewed; two items co-occur once per basket holding
both. The batch recommender keeps pairs seen in at least ``min_support``
baskets (2 in the batch job, 1 in the streaming job) and lists, per item, the
other items with their counts.

Scale design
------------
* Baskets are never materialised as one array per user on the pair path: a
  single user may own a third of all rows.
* A basket of ``n`` items is cut into ``nb = ceil(n / block_size)`` blocks by
  a hash of the item, and each block is gathered into one sorted array: a
  collect bounded by the block size, whatever the basket size. Pairs inside a
  block come from ``posexplode`` + ``slice`` (exactly ``k*(k-1)/2`` pairs, no
  join, no sort); pairs across blocks of a multi-block basket from groups by
  ``(user, block_lo, block_hi)``, so one huge basket spreads over
  ``nb*(nb+1)/2`` tasks of at most ``block_size**2`` pairs each instead of one
  task. Normal baskets are a single block and never get there. Only baskets
  above the block size need their size beforehand; it reaches their views
  through a salted lookup (:mod:`basketflow.operators.skew`), so a hot user's
  views are never gathered in one task.
* With ``prune=True`` and ``min_support > 1`` items seen in fewer baskets than
  the threshold are removed before pairing. That is exact: a pair can not be
  seen more often than either of its items. It costs one extra shuffle of the
  distinct views by item, so it is off by default and pays off on
  long-tailed catalogues where many items occur in a single basket.
* Counting is ``groupBy(a, b).count()``: partial aggregation before the
  shuffle, so a hot pair costs one row per map task.
* Joins carry no hints; AQE turns a join into a broadcast only when the
  runtime size of a side is under the broadcast threshold.

Item ids are compared as strings (``"10" < "9"``), as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from basketflow.operators.skew import size_lookup, with_large_size
from basketflow.session import materialise

# Target number of distinct items per block of a basket (bounds the block arrays
# and the pairs one task generates: about DEFAULT_BLOCK_SIZE**2).
DEFAULT_BLOCK_SIZE = 2048
# Hash buckets of the two-pass pair filter (bits of its table).
DEFAULT_BUCKETS = 1 << 24
MAX_BUCKETS = 1 << 26
# Pairs that a task of the placed counting makes.
PAIRS_PER_TASK = 4_000_000
# Alike items: most in a block (so that blocks even out over the cells), most
# baskets of an item, and most items on a side of a cell.
ALIKE_BLOCK, ALIKE_BASKETS, ALIKE_SIDE = 128, 4096, 1 << 16


def distinct_views(views: DataFrame, user: str = "user", item: str = "item",
                   scope: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(scope..., user, item)`` rows; items as strings, null ids
    dropped.

    ``scope`` columns (a time window, a batch id) split the data into
    independent basket populations. The distinct is hash-partitioned on all
    columns, so a hot user is spread over all partitions and duplicates are
    removed map-side first.
    """
    dv = _native_views(views, user, item, scope)
    return dv.withColumn("item", F.col("item").cast("string"))


def _native_views(views: DataFrame, user: str, item: str, scope: Sequence[str] = ()) -> DataFrame:
    """:func:`distinct_views` with integers left as they are: their text form is
    one-to-one, so they are de-duplicated on the native values (narrower shuffle
    rows, cheaper hashing) and cast after the shuffle."""
    native = isinstance(views.schema[item].dataType, (IntegralType, StringType))
    ids = F.col(item) if native else F.col(item).cast("string")
    return (views
            .select(*scope, F.col(user).alias("user"), ids.alias("item"))
            .where(F.col("user").isNotNull() & F.col("item").isNotNull())
            .distinct())


def _chunk_column(df: DataFrame, keys: Sequence[str], entry: str,
                  max_per_row: int) -> DataFrame:
    """Add ``part``: entries of a key with more than ``max_per_row`` entries
    are spread over ``ceil(n / max_per_row)`` parts by a hash of the entry, so
    no collected row grows past about ``max_per_row`` entries."""
    sized = with_large_size(df, keys, entry, max_per_row, "_n")
    parts = F.coalesce(F.ceil(F.col("_n") / F.lit(max_per_row)), F.lit(1)).cast("int")
    return (sized.withColumn("part", F.pmod(F.xxhash64(entry), parts).cast("int"))
            .drop("_n"))


def baskets(views: DataFrame, min_basket: int = 2, user: str = "user",
            item: str = "item", max_per_row: int | None = None) -> DataFrame:
    """A2 + P6: ``(user, basket, n)``, basket = sorted distinct items.

    This is the basket *report*; the pair path below never builds these
    arrays. Users with fewer than ``min_basket`` distinct items are dropped.
    With ``max_per_row`` a larger basket is reported as several rows
    ``(user, part, basket, n)``, each sorted (``n`` is the whole basket's
    size), so a hot user never becomes one huge row.
    """
    dv = distinct_views(views, user, item)
    if max_per_row is None:
        return (dv.groupBy("user")
                .agg(F.array_sort(F.collect_list("item")).alias("basket"),
                     F.count(F.lit(1)).alias("n"))
                .where(F.col("n") >= F.lit(min_basket)))
    sized = with_large_size(dv, ["user"], "item", max_per_row, "n")
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(max_per_row)), F.lit(1)).cast("int")
    rows = (sized.withColumn("part", F.pmod(F.xxhash64("item"), parts).cast("int"))
            .groupBy("user", "part")
            .agg(F.array_sort(F.collect_list("item")).alias("basket"), F.max("n").alias("n")))
    # A basket without a large size is a single part: its own length.
    return (rows.withColumn("n", F.coalesce(F.col("n"), F.size("basket").cast("long")))
            .where(F.col("n") >= F.lit(min_basket)))


def frequent_items(dv: DataFrame, min_support: int, scope: Sequence[str] = (),
                   rare: bool = False) -> DataFrame:
    """Items present in at least ``min_support`` baskets (per scope); with
    ``rare`` the others."""
    counted = dv.groupBy(*scope, "item").agg(F.count(F.lit(1)).alias("support"))
    enough = F.col("support") >= F.lit(min_support)
    return counted.where(~enough if rare else enough)


def item_pairs(views: DataFrame, min_basket: int = 2, min_support: int = 1,
               block_size: int = DEFAULT_BLOCK_SIZE, user: str = "user",
               item: str = "item", prune: bool = False,
               scope: Sequence[str] = ()) -> DataFrame:
    """Every ``(scope..., user, a, b)`` with ``a < b`` both in the user's
    basket (within the same scope).

    Only users with at least ``min_basket`` distinct items contribute.
    ``min_support`` is used for exact pruning only (see module doc); the
    support filter itself is applied by :func:`pair_support`.
    """
    if block_size < 1:
        raise ValueError("block_size must be positive")
    scope = list(scope)
    owner = scope + ["user"]
    dv = distinct_views(views, user, item, scope)
    work = dv.withColumn("_keep", F.lit(True))
    if prune and min_support > 1:
        # Items below the threshold are by nature not hot, but the views they
        # are looked up from are: the lookup table is written first, so that
        # it reaches the join as a plain scan and AQE can split a hot item.
        rare = materialise(frequent_items(dv, min_support, scope, rare=True)
                           .select(*scope, "item", F.lit(False).alias("_keep")), "rare-items")
        work = (dv.join(rare, scope + ["item"], "left")
                .withColumn("_keep", F.coalesce("_keep", F.lit(True))))

    sized = with_large_size(work, owner, "item", block_size, "_n")
    tagged = (sized.withColumn("nb", F.coalesce(F.ceil(F.col("_n") / F.lit(block_size)),
                                                F.lit(1)).cast("int"))
              .where(F.col("_n").isNull() | (F.col("_n") >= F.lit(max(2, min_basket))))
              .withColumn("blk", F.pmod(F.xxhash64("item"), F.col("nb")).cast("int")))
    # One sorted array per (basket, block): bounded by the block size. The
    # repartition spreads a hot basket's blocks over tasks. Its partition
    # count is pinned to the session's shuffle partitions: the stage's output
    # (the pairs) is far larger than its input, so AQE must not coalesce it by
    # input size. The number of blocks travels as an aggregate, so no filter
    # on it goes below the gathering and all branches read one exchange.
    n_parts = int(views.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (tagged.select(*owner, "blk", "nb", "item", "_keep")
              .repartition(n_parts, *owner, "blk")
              .groupBy(*owner, "blk")
              .agg(F.array_sort(F.collect_list(F.when(F.col("_keep"), F.col("item")))).alias("items"),
                   F.count(F.lit(1)).alias("rows"), F.max("nb").alias("nb")))
    # Pairs inside a block: item at position p with every later item.
    inner = (blocks.where((F.col("nb") > 1) | (F.col("rows") >= F.lit(max(2, min_basket))))
             .select(*owner, "items", F.posexplode("items").alias("pos", "a"))
             .select(*owner, "a", F.explode(F.slice("items", F.col("pos") + 2,
                                                    F.size("items"))).alias("b")))
    # Pairs across blocks of multi-block baskets: every two blocks of a basket
    # meet in a group of their own, of at most block_size**2 pairs.
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: o != F.col("blk")))
    meet = (blocks.where((F.col("nb") > 1) & (F.col("rows") > 0))
            .select(*owner, "blk", "items", other.alias("o"))
            .select(*owner, "blk", "items", F.least("blk", "o").alias("lo"),
                    F.greatest("blk", "o").alias("hi"))
            .repartition(n_parts, *owner, "lo", "hi")
            .groupBy(*owner, "lo", "hi")
            .agg(F.collect_list(F.when(F.col("blk") == F.col("lo"), F.col("items"))).alias("left"),
                 F.collect_list(F.when(F.col("blk") == F.col("hi"), F.col("items"))).alias("right")))
    cross = (meet.select(*owner, F.explode(F.flatten("left")).alias("x"),
                         F.flatten("right").alias("right"))
             .select(*owner, "x", F.explode("right").alias("y"))
             .select(*owner, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return inner.unionByName(cross)


def frequent_buckets(pairs: DataFrame, min_support: int, buckets: int,
                     scope: Sequence[str] = ()) -> DataFrame:
    """``(word, bits)``: the hash buckets that at least ``min_support`` pairs
    fall into, as a bit table of at most ``buckets / 64`` rows.

    Counting is partial: a task shuffles at most one row per bucket, however
    many pairs it makes.
    """
    bucket = _pair_bucket(buckets, scope)
    counted = pairs.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= F.lit(min_support))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bucket") % 64).cast("int"))
    return counted.groupBy(F.shiftright("bucket", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _pair_bucket(buckets: int, scope: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*scope, "a", "b"), F.lit(buckets).cast("bigint"))


def drop_rare_buckets(pairs: DataFrame, min_support: int, buckets: int = DEFAULT_BUCKETS,
                      scope: Sequence[str] = ()) -> DataFrame:
    """A1 + P8, second pass: ``pairs`` without those whose bucket is below the
    support. Exact: a pair can not occur more often than its bucket is hit.

    The bit table is broadcast: ``buckets / 64`` rows of two longs at most
    (4 MB by default), whatever the data.
    """
    if not 64 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 64 and {MAX_BUCKETS}")
    table = F.broadcast(frequent_buckets(pairs, min_support, buckets, scope))
    bucket = _pair_bucket(buckets, scope)
    tagged = pairs.withColumn("word", F.shiftright(bucket, 6)).withColumn("_bit", (bucket % 64).cast("int"))
    return tagged.join(table, "word").where(F.getbit("bits", F.col("_bit")) == 1).drop("word", "bits", "_bit")


def pair_support(views: DataFrame, min_basket: int = 2, min_support: int = 2,
                 block_size: int = DEFAULT_BLOCK_SIZE, user: str = "user",
                 item: str = "item", prune: bool = False,
                 scope: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """P5 + A1 + P8: ``(scope..., a, b, cnt)`` = number of baskets (of the
    same scope) holding both.

    Pairs seen in fewer than ``min_support`` baskets are dropped (the batch
    job uses 2, the streaming job 1). With ``buckets`` a first pass over the
    pairs fills a bounded bit table, and pairs of rare buckets go before the
    shuffle (:func:`drop_rare_buckets`). Both passes read the same shuffled
    blocks. It pays off where most pairs occur once.
    """
    pairs = item_pairs(views, min_basket, min_support, block_size, user, item, prune, scope)
    if buckets is not None and min_support > 1:
        pairs = drop_rare_buckets(pairs, min_support, buckets, scope)
    counted = pairs.groupBy(*scope, "a", "b").agg(F.count(F.lit(1)).alias("cnt"))
    if min_support > 1:
        counted = counted.where(F.col("cnt") >= F.lit(min_support))
    return counted


def placed_pair_support(views: DataFrame, min_basket: int = 2, min_support: int = 2,
                        block_size: int = DEFAULT_BLOCK_SIZE, user: str = "user",
                        item: str = "item") -> DataFrame:
    """:func:`pair_support` for pairs that seldom come twice in a task, so that
    partial counts save nothing: items are brought to the place where their
    pairs are made *and* counted, and no pair is shuffled.

    * Baskets of one block: an item travels once with the later items of its
      basket. Its pairs are counted where the item is; a hot item's are dealt
      over salts by the other one.
    * If a basket exceeds the block size, all items are dealt into as many
      blocks as the largest basket has, the same for all baskets, and pairs are
      counted in the cell of their two blocks. A large basket sends each block
      to the cells of its row and column; pairs of small ones travel as such.
    * Then, if many items are in the very same baskets (few baskets hold most
      of the views), a pair's count is that of its two items' blocks: blocks of
      such alike items meet once, not once in every basket, and each of their
      pairs is made once, counted already (:func:`_alike_pairs`).

    Pairs are counted as native values and become text at the end. A partition
    makes about ``PAIRS_PER_TASK`` pairs, so that its counts fit in memory.
    """
    if block_size < 1:
        raise ValueError("block_size must be positive")
    least = max(2, min_basket)
    dv = materialise(_native_views(views, user, item), "views")
    n = F.col("n")
    sizes = dv.groupBy("user").agg(F.count(F.lit(1)).alias("n")).where(n >= F.lit(least))
    total = sizes.agg(F.max("n").alias("n"), F.sum(n * (n - 1) / 2).alias("pairs")).first()
    n_parts = int(views.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = max(n_parts, ceil((total.pairs or 0) / PAIRS_PER_TASK))
    if (total.n or 0) <= block_size:
        pairs, place = _striped_pairs(dv, least, block_size, n_parts, places)
    elif (alike := _alike_pairs(dv, least, min_support, block_size, total.pairs, n_parts)) is not None:
        return alike
    else:
        pairs, place = _cell_pairs(dv, least, block_size, ceil(total.n / block_size), n_parts, places)
    counted = pairs.groupBy(*place, "a", "b").agg(F.count(F.lit(1)).alias("cnt"))
    if min_support > 1:
        counted = counted.where(F.col("cnt") >= F.lit(min_support))
    a, b = F.col("a").cast("string"), F.col("b").cast("string")
    return counted.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "cnt")


def _stripes(dv: DataFrame, least: int, n_parts: int) -> DataFrame:
    """``(a, rest)``: every item with the later ones of its basket."""
    gathered = (dv.repartition(n_parts, "user").groupBy("user")
                .agg(F.array_sort(F.collect_list("item")).alias("items")))
    return (gathered.where(F.size("items") >= F.lit(least))
            .select("items", F.posexplode("items").alias("pos", "a"))
            .select("a", F.slice("items", F.col("pos") + 2, F.size("items")).alias("rest"))
            .where(F.size("rest") > 0))


def _striped_pairs(dv: DataFrame, least: int, block_size: int, n_parts: int,
                   places: int) -> tuple[DataFrame, list[str]]:
    hot, _ = size_lookup(dv, ["item"], block_size, "n", n_parts)
    salted = _stripes(dv, least, n_parts).join(F.broadcast(hot.withColumnRenamed("item", "a")), "a", "left")
    salt = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    own = F.filter("rest", lambda b: F.pmod(F.xxhash64(b), F.col("_salts")) == F.col("salt"))
    placed = (salted.withColumn("salt", salt)
              .select("a", "salt", F.when(F.col("_salts").isNull(), F.col("rest")).otherwise(own).alias("rest"))
              .where(F.size("rest") > 0).repartition(places, "a", "salt"))
    return placed.select("a", "salt", F.explode("rest").alias("b")), ["a", "salt"]


def _cell_pairs(dv: DataFrame, least: int, block_size: int, grid: int, n_parts: int,
                places: int) -> tuple[DataFrame, list[str]]:
    block = lambda x: F.pmod(F.xxhash64(x), F.lit(grid)).cast("int")
    place = ["lo", "hi"]
    # A basket that is no larger than the grid has fewer pairs than copies.
    sized = with_large_size(dv, ["user"], "item", max(block_size, grid), "_n")
    blocks = (sized.where(F.col("_n") >= F.lit(least)).withColumn("blk", block("item"))
              .repartition(n_parts, "user", "blk").groupBy("user", "blk")
              .agg(F.collect_list("item").alias("items")))
    side = lambda k: F.flatten(F.collect_list(F.when(F.col("blk") == F.col(k), F.col("items"))))
    meet = (blocks.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
            .select("user", "blk", "items", F.least("blk", "o").alias("lo"), F.greatest("blk", "o").alias("hi"))
            .repartition(places, *place).groupBy("user", *place)
            .agg(side("lo").alias("left"), side("hi").alias("right")))
    large = (meet.select(*place, F.explode("left").alias("x"), "right")
             .select(*place, "x", F.explode("right").alias("y"))
             .where((F.col("lo") < F.col("hi")) | (F.col("x") < F.col("y")))
             .select(*place, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    small = (_stripes(sized.where(F.col("_n").isNull()).select("user", "item"), least, n_parts)
             .select("a", F.explode("rest").alias("b"))
             .select(F.least(block("a"), block("b")).alias("lo"), F.greatest(block("a"), block("b")).alias("hi"), "a", "b")
             .repartition(places, *place))
    return large.unionByName(small), place


def _alike_pairs(dv: DataFrame, least: int, min_support: int, block_size: int,
                 basket_pairs: float, n_parts: int) -> DataFrame | None:
    """``(a, b, cnt)`` from blocks of alike items (those of the same baskets),
    or None if items are so little alike that all blocks' meetings, each as
    long as the block's list of baskets, cost more than all baskets' pairs.

    Blocks are dealt over both sides of a triangle of cells, and each pair of
    blocks meets in one cell: it has as many common baskets as any of its
    pairs. Pairs of blocks below the support are not unfolded, so no more
    pairs are made than there are in the baskets.
    """
    size = min(block_size, ALIKE_BLOCK)
    kept = with_large_size(dv, ["user"], "item", least - 1, "_n").where(F.col("_n").isNotNull()).drop("_n")
    # Only for the choice are lists of baskets taken as their hashes.
    lists = kept.groupBy("item").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("user")).alias("h"))
    units = F.ceil(F.col("m") / F.lit(size))
    est = (lists.groupBy("k", "h").agg(F.count(F.lit(1)).alias("m"))
           .agg(F.max("k").alias("k"), F.sum("m").alias("items"), F.sum(units).alias("units"),
                F.sum(units * F.col("k")).alias("entries")).first())
    if est.k > ALIKE_BASKETS or est.units * est.entries > basket_pairs:
        return None
    made = min(basket_pairs, est.items * (est.items - 1) / 2)
    sides = max(ceil(sqrt(2 * max(n_parts, made / PAIRS_PER_TASK))), ceil(est.items / ALIKE_SIDE))
    cells = sides * (sides + 1) // 2
    users = (kept.groupBy("item").agg(F.array_sort(F.collect_list("user")).alias("users"))
             .withColumn("item", F.col("item").cast("string")))
    # Blocks are ranges of their group's items: of two blocks mostly one holds
    # the lesser items, so that written columns have runs.
    ranges = min(n_parts, ceil(est.items / (64 * size)))
    ranged = users.repartitionByRange(ranges, "users", "item").withColumn("range", F.spark_partition_id())
    nth = F.row_number().over(Window.partitionBy("range", "users").orderBy("item"))
    blocks = (ranged.withColumn("blk", F.floor((nth - 1) / F.lit(size)))
              .groupBy("range", "users", "blk").agg(F.array_sort(F.collect_list("item")).alias("items"))
              .withColumn("side", F.pmod(F.xxhash64("range", "users", "blk"), F.lit(sides)).cast("int")))
    lo, hi = F.least("side", "o"), F.greatest("side", "o")
    entry = F.struct("users", "items")
    meet = (blocks.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
            .select((F.shiftright(hi * (hi + 1), 1) + lo).alias("cell"), (lo == hi).alias("corner"),
                    (F.col("side") == lo).alias("left"), (F.col("side") == hi).alias("right"), entry.alias("e"))
            .repartitionById(cells, "cell").groupBy("cell", "corner")
            .agg(F.collect_list(F.when(F.col("left"), F.col("e"))).alias("left"),
                 F.collect_list(F.when(F.col("right"), F.col("e"))).alias("right")))
    # On the corner both sides hold the same blocks in the same order. Generated
    # code would hold all that a row unfolds to: transform() keeps these two
    # steps out of it, so that no more than two blocks' pairs are held.
    apart = lambda i, j: ~F.col("corner") | (i < j)
    common = lambda y: F.size(F.array_intersect(F.col("x.users"), y["users"])).cast("long")
    left = F.transform("left", lambda x, i: F.struct(x["users"].alias("users"), x["items"].alias("items"), i.alias("i")))
    right = F.transform("right", lambda y, j: F.struct(
        y["items"].alias("items"), apart(F.col("x.i"), j).alias("apart"),
        F.when(apart(F.col("x.i"), j) | (F.col("x.i") == j), common(y)).otherwise(0).alias("cnt")))
    enough = F.filter(right, lambda y: y["cnt"] >= F.lit(max(1, min_support)))
    first = lambda items: items.getItem(0)
    turned = first(F.col("y.items")) < first(F.col("x.items"))
    met = (meet.select("corner", F.explode(left).alias("x"), "right")
           .select("x", F.explode(enough).alias("y"))
           .select("y.apart", "y.cnt", F.when(turned, F.col("y.items")).otherwise(F.col("x.items")).alias("xs"),
                   F.when(turned, F.col("x.items")).otherwise(F.col("y.items")).alias("ys")))
    # In order: the blocks' ranges don't overlap, or it is one block.
    pairs = (met.withColumn("ordered", ~F.col("apart") | (F.element_at("xs", -1) < first(F.col("ys"))))
             .select("apart", "ordered", "cnt", "ys", F.explode("xs").alias("x"))
             .select("apart", "ordered", "cnt", "x", F.explode("ys").alias("y"))
             .where(F.col("apart") | (F.col("x") < F.col("y"))))
    a = F.when(F.col("ordered"), F.col("x")).otherwise(F.least("x", "y"))
    b = F.when(F.col("ordered"), F.col("y")).otherwise(F.greatest("x", "y"))
    return pairs.select(a.alias("a"), b.alias("b"), "cnt")


def symmetric_pairs(pairs: DataFrame, a: str = "a", b: str = "b",
                    cnt: str = "cnt") -> DataFrame:
    """``(a, b, n)`` -> ``(a, b, n)`` and ``(b, a, n)`` in one pass."""
    both = F.explode(F.array(
        F.struct(F.col(a).alias("item"), F.col(b).alias("other"), F.col(cnt).alias("cnt")),
        F.struct(F.col(b).alias("item"), F.col(a).alias("other"), F.col(cnt).alias("cnt"))))
    return pairs.select(both.alias("_p")).select("_p.item", "_p.other", "_p.cnt")


def recommendations_flat(views: DataFrame, min_basket: int = 2, min_support: int = 2,
                         block_size: int = DEFAULT_BLOCK_SIZE, user: str = "user",
                         item: str = "item", prune: bool = False) -> DataFrame:
    """A5 in flat form: ``(item, other, cnt)``, one row per neighbour.

    This is the form to write at scale: no row grows with an item's
    popularity.
    """
    return symmetric_pairs(pair_support(views, min_basket, min_support, block_size,
                                        user, item, prune))


def top_neighbours(flat: DataFrame, n: int, salt_buckets: int = 64,
                   keys: tuple[str, ...] = ("item",)) -> DataFrame:
    """Exact top-``n`` neighbours per item (cnt desc, other asc).

    Two rounds so a popular item is not ranked in one task: first the top
    ``n`` inside each ``(item, hash(other) % salt_buckets)`` group, then the
    top ``n`` of those at most ``n * salt_buckets`` candidates.
    """
    order = [F.col("cnt").desc(), F.col("other").asc()]
    salted = flat.withColumn("_salt", F.pmod(F.xxhash64("other"), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = (salted.withColumn("_r", F.row_number().over(w1))
              .where(F.col("_r") <= F.lit(n)).drop("_r", "_salt"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (stage1.withColumn("_r", F.row_number().over(w2))
            .where(F.col("_r") <= F.lit(n)).drop("_r"))


def nest_recommendations(flat: DataFrame, keys: tuple[str, ...] = ("item",),
                         max_per_row: int | None = None) -> DataFrame:
    """A3: ``(item, recs)`` with ``recs = array<struct<other, cnt>>``.

    The reference leaves the list order unspecified; we fix it to cnt
    descending, then other ascending. ``keys`` adds grouping columns (e.g.
    ``batch_id``) next to ``item``. ``max_per_row`` splits an item with more
    neighbours into several rows ``(item, part, recs)``, each ordered, so a
    popular item never becomes one huge row or message.
    """
    group = list(keys)
    if max_per_row is not None:
        # The sizes of the lists are asked for several times: written once,
        # the rows are not counted anew for each.
        flat = _chunk_column(materialise(flat, "lists"), keys, "other", max_per_row)
        group.append("part")
    entries = F.collect_list(F.struct((-F.col("cnt")).alias("k"), F.col("other"),
                                      F.col("cnt")))
    ordered = F.transform(F.array_sort(entries),
                          lambda e: F.struct(e["other"].alias("other"),
                                             e["cnt"].alias("cnt")))
    return flat.groupBy(*group).agg(ordered.alias("recs"))


def cooccurrence(views: DataFrame, min_basket: int = 2, min_support: int = 2,
                 block_size: int = DEFAULT_BLOCK_SIZE, user: str = "user", item: str = "item",
                 max_per_row: int | None = None, prune: bool = False) -> DataFrame:
    """A5, the flagship batch recommender: views -> ``(item, recs)``.

    S1 -> P1 (done by the caller) -> A2 -> P6 -> P7 -> A1 -> P8 -> P9 -> A3.
    """
    flat = recommendations_flat(views, min_basket, min_support, block_size, user, item, prune)
    return nest_recommendations(flat, max_per_row=max_per_row)

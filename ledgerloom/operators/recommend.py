"""Item-to-item recommendations from co-purchases.

Quantities are whole numbers, so dot products and norms are exact BIGINT sums. Similarities are
added up as whole multiples of 1e-12: results do not depend on the order in which Spark sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType

from ..session import scratch_path
from .clean import by_status
from .ranking import top_n_per

SCALE = 10**12
BLOCK = 1024  # products of one customer per block; one join key pairs two blocks
PAIRS = 1_000_000  # pairs per task of the pair join, about a join key of the largest kind
SUMS = 2_000_000  # scores per task where they are summed by customer
MOST_TASKS = 100_000
PAIRED = ("norm2", "norm2_b", "floor")  # what belongs to the two products of a pair
PROBE = (4, 16)  # one in so many products, at least and at most, takes part in a first look at similarities


def interactions(sales: DataFrame, orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """Lines of orders with the status: order, product, quantity, customer."""
    buyers = by_status(orders, status).select("order_id", "customer_id")
    return sales.select("order_id", "product_id", "quantity").join(buyers, "order_id")


def user_item(rows: DataFrame) -> DataFrame:
    """Quantity per customer and product, positive ones only: the sparse purchase matrix."""
    keyed = rows.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    totals = keyed.groupBy("customer_id", "product_id").agg(F.sum("quantity").alias("qty"))
    return totals.filter("qty > 0")


def _sized(matrix: DataFrame) -> DataFrame:
    """The matrix with the squared norm of each product and the blocks its customer's products are cut into."""
    norms = matrix.groupBy("product_id").agg(F.sum(F.col("qty") * F.col("qty")).alias("norm2"))
    sizes = matrix.groupBy("customer_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return matrix.join(norms, "product_id").join(sizes, "customer_id")


def _blocked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the pair join, with customers of many products cut into blocks.

    The b = ceil(m / BLOCK) blocks of a customer with m products meet in pairs (lo, hi), lo <= hi.
    A product of block k is the lower one in (k, k..b-1) and the higher one in (0..k, k). So a join
    key makes about BLOCK x BLOCK pairs however large the customer is, every two products meet under
    one key, and customers of up to BLOCK products are not copied at all.
    """
    block = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    product = F.struct("product_id", "qty", "norm2", "floor")
    low = rows.select("customer_id", block.alias("lo"), "blocks", product.alias("x"))
    high = rows.select("customer_id", block.alias("hi"), product.alias("y"))
    low = low.withColumn("hi", F.explode(F.sequence("lo", F.col("blocks") - 1))).drop("blocks")
    return low, high.withColumn("lo", F.explode(F.sequence(F.lit(0), "hi")))


def _staged(matrix: DataFrame) -> DataFrame:
    """The matrix as a written table: norms, sizes and both sides of the join read it."""
    spark = matrix.sparkSession
    path = scratch_path(spark, "matrix")
    matrix.write.parquet(path)
    return spark.read.schema(matrix.schema).parquet(path)


def _pair_count(matrix: DataFrame) -> int:
    """Pairs that the customers' products make, those of a product with itself included."""
    m = F.col("m").cast("double")
    sizes = matrix.groupBy("customer_id").agg(F.count("*").alias("m"))
    return int(sizes.agg(F.sum(m * (m + 1) / 2)).first()[0] or 0)


def _tasks(matrix: DataFrame, work: int, each: int) -> int:
    return min(max(matrix.sparkSession.sparkContext.defaultParallelism, -(-work // each)), MOST_TASKS)


def _pair_tasks(matrix: DataFrame, pairs: int) -> int:
    """Tasks for the pair join: as many as give each ``PAIRS`` pairs on average, and one for each core at least."""
    return _tasks(matrix, pairs, PAIRS)


def _pairs(rows: DataFrame, tasks: int) -> DataFrame:
    """Products bought by a common customer, smaller id first, with dot product, norms and floors."""
    low, high = _blocked(rows)
    # few bytes make many pairs, so the work sets the number of tasks and AQE must not merge them
    keys = ["customer_id", "lo", "hi"]
    met = low.repartition(tasks, *keys).join(high, keys)
    x, y = F.col("x"), F.col("y")
    ordered = x["product_id"] < y["product_id"]
    pairs = met.filter((F.col("lo") < F.col("hi")) | ordered).select(
        F.when(ordered, x).otherwise(y).alias("a"), F.when(ordered, y).otherwise(x).alias("b")
    )
    # the norms belong to the two products: carried along, they save two joins of the pairs
    return pairs.groupBy(F.col("a.product_id").alias("product_id_a"), F.col("b.product_id").alias("product_id_b")).agg(
        F.sum(F.col("a.qty") * F.col("b.qty")).alias("dot"),
        *[F.max(f"{end}.{c}").alias(f"{c}_{end}") for c in ("norm2", "floor") for end in ("a", "b")],
    )


def item_pairs(matrix: DataFrame) -> DataFrame:
    """Products bought by a common customer, smaller id first, with dot product and norms.

    These pairs are the result of the similarity job, so none can be left out. What is kept
    small is the way there: pairs are summed in the task that makes them, before the shuffle,
    and large customers are spread over many join keys.
    """
    matrix = _staged(matrix)
    rows = _sized(matrix).withColumn("floor", F.lit(0).cast("bigint"))
    return _pairs(rows, _pair_tasks(matrix, _pair_count(matrix))).drop("floor_a", "floor_b")


def cosine(end_a: str = "norm2_a", end_b: str = "norm2_b") -> Column:
    return F.col("dot").cast("double") / F.sqrt(F.col(end_a).cast("double") * F.col(end_b).cast("double"))


def item_similarity(matrix: DataFrame) -> DataFrame:
    """(product, neighbour, cosine similarity) in both directions, positive similarities only."""
    pairs = item_pairs(matrix)
    both = F.array(
        F.struct(F.col("product_id_a").alias("product_id"), F.col("product_id_b").alias("neighbour_id")),
        F.struct(F.col("product_id_b").alias("product_id"), F.col("product_id_a").alias("neighbour_id")),
    )
    return pairs.select(F.inline(both), cosine().alias("similarity"))


def points(similarity: Column) -> Column:
    """Similarity as a whole number; equal cosines stay equal whatever the last bits say."""
    return F.round(similarity * SCALE).cast("bigint")


def nearest_items(similarity: DataFrame, neighbours: int = 19) -> DataFrame:
    order = [F.desc(points(F.col("similarity"))), F.asc("neighbour_id")]
    return top_n_per(similarity, ["product_id"], order, neighbours)


def probe_of(pairs: int, products: int, neighbours: int) -> int:
    """One in how many products to probe, 0 for no probe.

    A probe of one in p costs 2 / p of the pair join and leaves p x ``neighbours`` pairs of a product to
    rank. It pays if a product has several times as many.
    """
    least, most = PROBE
    p = min(most, 2 * pairs // max(1, products) // (4 * neighbours))
    return p if p >= least else 0


def similarity_floors(rows: DataFrame, neighbours: int, probed: int) -> DataFrame:
    """(product_id, floor): points that a product's nearest ``neighbours`` have at least.

    The ``neighbours``-th best among one in ``probed`` of all products cannot be better than among all of
    them, so it bounds from below what counts. Products with too few neighbours in the probe have no row.
    ``rows`` is the matrix with norm2 and blocks; a customer's products meet the probe block by block.
    """
    block = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    probe = rows.filter(F.pmod(F.xxhash64("product_id", F.lit(1)), F.lit(probed)) == 0)
    probe = probe.select(
        "customer_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("product_id").alias("neighbour_id"), F.col("qty").alias("qty_b"), F.col("norm2").alias("norm2_b"),
    )
    met = rows.withColumn("block", block).join(probe, ["customer_id", "block"]).filter("product_id <> neighbour_id")
    pairs = met.groupBy("product_id", "neighbour_id").agg(
        F.sum(F.col("qty") * F.col("qty_b")).alias("dot"), F.max("norm2").alias("norm2_a"), F.max("norm2_b").alias("norm2_b")
    )
    scored = pairs.select("product_id", points(cosine()).alias("floor"))
    last = top_n_per(scored, ["product_id"], [F.desc("floor")], neighbours).filter(F.col("rank") == neighbours)
    return last.select("product_id", "floor")


def narrowest(kind: DataType, least: int | None, most: int | None) -> str:
    """The smallest whole-number type that holds all from ``least`` to ``most``; other types stay."""
    if isinstance(kind, (LongType, IntegerType)) and least is not None:
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if -(1 << bits) <= least and most < 1 << bits:
                return name
    return kind.simpleString()


def _dealt(rows: DataFrame, tasks: int, split: bool, kinds: dict[str, str]) -> DataFrame:
    """A row per purchase: the product, and all products of its customer as arrays of ``kinds``, itself included.

    A customer's products are gathered block by block. With ``split``, some have several blocks, and each block meets
    each as a join key of its own; other customers' products come from one array without a join.
    """
    block = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("customer_id"), F.col("parts")).cast("int")
    own = F.struct("product_id", "qty", "norm2", "floor", "parts", part.alias("part"))
    # few bytes make many pairs, so the work sets the number of tasks and AQE must not merge them
    dealt = rows.withColumn("block", block).repartition(tasks, "customer_id", "block")
    lists = dealt.groupBy("customer_id", "block").agg(F.max("blocks").alias("blocks"), F.collect_list(own).alias("x"))
    met = lists.filter("blocks = 1").select("x", F.col("x").alias("y"))
    if split:
        large, blocks = lists.filter("blocks > 1"), F.sequence(F.lit(0), F.col("blocks") - 1)
        low = large.select("customer_id", F.col("block").alias("lo"), F.explode(blocks).alias("hi"), "x")
        high = large.select("customer_id", F.explode(blocks).alias("lo"), F.col("block").alias("hi"), F.col("x").alias("y"))
        met = met.union(low.join(high, ["customer_id", "lo", "hi"]).select("x", "y"))
    y = F.col("y")
    arrays = [y[c].cast(f"array<{kind}>").alias(f"{c}_of") for c, kind in kinds.items()]
    return met.select(F.explode("x").alias("own"), *arrays).select("own.*", *[f"{c}_of" for c in kinds])


def _scored(purchases: DataFrame, *keys: str) -> DataFrame:
    """Dot products of a product and its neighbours, summed by ``keys`` in the tasks that ``purchases`` was dealt to."""
    each = F.inline(F.arrays_zip("product_id_of", "qty_of", "norm2_of")).alias("neighbour_id", "qty_b", "norm2_b")
    pairs = purchases.select(*keys, "qty", "norm2", "floor", each)
    for c, of in (("neighbour_id", "product_id"), ("qty_b", "qty"), ("norm2_b", "norm2")):
        pairs = pairs.withColumn(c, F.col(c).cast(purchases.schema[of].dataType))
    return pairs.filter("product_id <> neighbour_id").groupBy(*keys, "neighbour_id").agg(
        F.sum(F.col("qty") * F.col("qty_b")).alias("dot"), *[F.max(c).alias(c) for c in PAIRED]
    )


def nearest_neighbours(matrix: DataFrame, neighbours: int = 19) -> DataFrame:
    """(product_id, neighbour_id, points): the most similar products of each, equal ones by id.

    The same rows as ``nearest_items`` of ``item_similarity``. Pairs are not shuffled: customers' products go to the task
    of each product as arrays, and pairs are made, summed and ranked there. A product whose customers make more than
    ``PAIRS`` pairs is dealt to several tasks, which sum before they send. Where products have many neighbours, a pair is
    ranked only if it reaches the floor of its product. ``matrix`` is a written table.
    """
    rows = _sized(matrix)
    sizes = matrix.groupBy("customer_id").agg(F.count("*").alias("m"))
    squares = F.sum(F.col("qty") * F.col("qty")).alias("norm2")
    work = matrix.join(sizes, "customer_id").groupBy("product_id").agg(F.sum("m").alias("work"), F.max("qty").alias("qty"), squares)
    products, directed, hottest, qty, norm2, least, most = work.agg(
        F.count("*"), F.sum("work"), *[F.max(c) for c in ("work", "qty", "norm2")], F.min("product_id"), F.max("product_id")
    ).first()
    bounds = {"product_id": (least, most), "qty": (0, qty or 0), "norm2": (0, norm2 or 0)}
    kinds = {c: narrowest(rows.schema[c].dataType, *b) for c, b in bounds.items()}
    many = ((directed or 0) + matrix.count()) // 2
    rows = rows.join(work.select("product_id", F.ceil(F.col("work") / PAIRS).cast("int").alias("parts")), "product_id")
    probed = probe_of(many, products, neighbours)
    none = F.lit(0).cast("bigint")
    if probed:
        rows = rows.join(similarity_floors(rows, neighbours, probed), "product_id", "left").withColumn("floor", F.coalesce("floor", none))
    else:
        rows = rows.withColumn("floor", none)
    tasks = _pair_tasks(matrix, many)
    purchases = _dealt(rows, tasks, not sizes.filter(F.col("m") > BLOCK).isEmpty(), kinds)

    def best(pairs: DataFrame) -> DataFrame:
        reached = pairs.withColumn("points", points(cosine("norm2", "norm2_b"))).filter("points >= floor")
        reached = reached.select("product_id", "neighbour_id", "points")
        return top_n_per(reached, ["product_id"], [F.desc("points"), F.asc("neighbour_id")], neighbours)

    few = best(_scored(purchases.filter("parts = 1").repartition(tasks, "product_id"), "product_id"))
    if (hottest or 0) <= PAIRS:
        return few
    some = _scored(purchases.filter("parts > 1").repartition(tasks, "product_id", "part"), "product_id", "part")
    whole = some.groupBy("product_id", "neighbour_id").agg(F.sum("dot").alias("dot"), *[F.max(c).alias(c) for c in PAIRED])
    return few.union(best(whole))


def candidate_scores(matrix: DataFrame, nearest: DataFrame, neighbours: int = 19) -> DataFrame:
    """Summed similarity of every neighbour of a customer's products that the customer does not own.

    A product's neighbours travel to its customers as arrays and are summed where a customer's arrays meet; sums of
    customers with more than ``BLOCK`` products are spread over the tasks by product instead. The products owned take
    part as rows without points, so no further join takes them out. A product without neighbours is nobody's neighbour.
    """
    near = F.sort_array(F.collect_list(F.struct("neighbour_id", "points")))
    lists = nearest.groupBy("product_id").agg(near.alias("near"))
    kind = matrix.schema["product_id"].dataType
    ids = narrowest(kind, *matrix.agg(F.min("product_id"), F.max("product_id")).first())
    lists = lists.select("product_id", F.col("near")["neighbour_id"].cast(f"array<{ids}>").alias("ids"), F.col("near")["points"].alias("points"))
    sizes = matrix.groupBy("customer_id").agg(F.count("*").alias("m"))
    rows, most = sizes.agg(F.sum("m"), F.max("m")).first()
    own = F.struct("product_id", F.lit(None).cast("bigint").alias("points"))

    def summed(owned: DataFrame, tasks: int | None) -> DataFrame:
        found = owned.join(lists, "product_id")
        if tasks:
            found = found.repartition(tasks, "customer_id")
        near = F.transform(F.arrays_zip("ids", "points"), lambda x: F.struct(x["ids"].cast(kind).alias("product_id"), x["points"].alias("points")))
        sums = found.select("customer_id", F.inline(F.concat(F.array(own), near))).groupBy("customer_id", "product_id")
        sums = sums.agg(F.sum("points").alias("points"), F.count("points").alias("times"), F.count("*").alias("rows"))
        return sums.filter("times = rows").select("customer_id", "product_id", "points")

    owned, tasks = matrix.select("customer_id", "product_id"), _tasks(matrix, (rows or 0) * (neighbours + 1), SUMS)
    if (most or 0) <= BLOCK:
        return summed(owned, tasks)
    large = sizes.filter(F.col("m") > BLOCK)
    few = summed(owned.join(large, "customer_id", "left_anti"), tasks)
    return few.union(summed(owned.join(large, "customer_id", "left_semi"), None))


def exclude_purchased(candidates: DataFrame, matrix: DataFrame) -> DataFrame:
    owned = matrix.select("customer_id", "product_id")
    return candidates.join(owned, ["customer_id", "product_id"], "left_anti")


def recommend(matrix: DataFrame, top_n: int = 5, neighbours: int = 19) -> DataFrame:
    """The best ``top_n`` products each customer does not own yet.

    The matrix is written once; pairs, scores and the exclusion read it. With fewer than two
    customers or products nothing is left to recommend and the result is empty, with the same columns.
    """
    matrix = _staged(matrix)
    fresh = candidate_scores(matrix, nearest_neighbours(matrix, neighbours), neighbours)
    best = top_n_per(fresh, ["customer_id"], [F.desc("points"), F.asc("product_id")], top_n)
    return best.select(
        "customer_id",
        F.col("product_id").alias("recommended_product_id"),
        F.bround(F.col("points") / SCALE, 4).alias("score"),
    )

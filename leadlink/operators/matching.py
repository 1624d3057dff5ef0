"""Exact identity join, blocked nearest neighbours, six-set scores and one-to-one resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import fiscal, scores, vectors

R = Rules()


def in_scope(column: str, scope: frozenset[int] | None) -> Column:
    return F.lit(True) if scope is None else F.col(column).isin(*sorted(scope))


def exact_pairs(leads: DataFrame, pos: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs with equal territory and identity keys, all of them filled. Both sides have `keys`."""
    full = [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys]
    for c in full:
        leads, pos = leads.where(c), pos.where(c)
    return leads.join(pos, keys)


def exclude_exact(df: DataFrame, key: str, decisions: DataFrame, transactions: DataFrame | None = None, rules: Rules = R) -> DataFrame:
    """Rows whose key no exact decision, and no exactly matched transaction, owns."""
    owned = decisions.where(scores.is_exact(F.col("match_type"), F.col("final_score"), rules)).select(key)
    df = df.join(owned, key, "left_anti")
    if transactions is not None:
        taken = transactions.where(scores.is_exact(F.col("match_type"), F.col("match_score"), rules)).select(key)
        df = df.join(taken, key, "left_anti")
    return df


def new_only(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key), key, "left_anti")


def knn_blocked(leads: DataFrame, pos: DataFrame, block: str, k: int = R.top_k, gate: float = R.recall_gate, distinct_ids: bool = False, size: int = 4096) -> DataFrame:
    """The k nearest transactions (pos_id, v) of each lead (lead_id, v) in its block, by cosine of
    unit vectors, with a score of at least the gate. Ties go to the smaller pos_id.

    Blocks are cut into parts of about `size` vectors; each pair of parts gives its own top k by
    matrix products (see best_products), and these are ranked together. A task holds two parts.
    Vectors with a null component, and those of different lengths, have no score."""
    dim, keys = "__dim", [block, "__dim"]

    def of(df, id_):
        full = df.where(F.col("v").isNotNull() & F.col(block).isNotNull() & ~F.exists("v", lambda x: x.isNull()))
        full = full.where(F.col(id_).isNotNull()) if distinct_ids else full
        return full.select(block, id_, "v", F.size("v").alias(dim))

    def parts(df, name):
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"n_{name}"))

    left, right = of(leads, "lead_id"), of(pos, "pos_id")
    counts = parts(left, "l").join(parts(right, "r"), keys)
    left = left.join(counts, keys).withColumn("i", F.pmod(F.xxhash64("lead_id"), F.col("n_l")).cast("int"))
    right = right.join(counts, keys).withColumn("j", F.pmod(F.xxhash64("pos_id"), F.col("n_r")).cast("int"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_r") - 1))).select(F.col(block).alias("lb"), F.col(dim).alias("ld"), F.col("i").alias("li"), F.col("j").alias("lj"), F.col("lead_id").alias("l"), F.col("v").alias("x"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_l") - 1))).select(F.col(block).alias("rb"), F.col(dim).alias("rd"), F.col("i").alias("ri"), F.col("j").alias("rj"), F.col("pos_id").alias("p"), F.col("v").alias("y"))

    def best(key, a, b):
        import pandas as pd

        out = [pd.DataFrame({c: [] for c in [block, "lead_id", "pos_id", "raw"]})]
        if len(a) and len(b):
            b = b.sort_values("p")
            own, ids = a["l"].to_numpy(), b["p"].to_numpy()
            for i, j, raw in vectors.best_products(vectors.matrix(a["x"]), vectors.matrix(b["y"]), own, ids, k, gate, distinct_ids):
                out.append(pd.DataFrame({block: [key[0]] * len(i), "lead_id": own[i], "pos_id": ids[j], "raw": raw}))
        return pd.concat(out[1:] or out, ignore_index=True)

    kinds = dict(leads.dtypes) | dict(pos.dtypes)
    schema = f"`{block}` {kinds[block]}, lead_id {kinds['lead_id']}, pos_id {kinds['pos_id']}, raw double"
    found = left.groupBy("lb", "ld", "li", "lj").cogroup(right.groupBy("rb", "rd", "ri", "rj")).applyInPandas(best, schema)
    found = found.withColumn("raw", F.coalesce("raw", F.lit(float("nan"))))  # pandas gives NaN back as null
    nearest = Window.partitionBy(block, "lead_id").orderBy(F.desc("raw"), "pos_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def knn_matmul(leads: DataFrame, pos: DataFrame, block: str, k: int = R.top_k, gate: float = R.recall_gate, distinct_ids: bool = False, size: int = 4096) -> DataFrame:
    """knn_blocked under the name it had when that formed its pairs one by one."""
    return knn_blocked(leads, pos, block, k, gate, distinct_ids, size)


def with_fiscal_class(pairs: DataFrame, rules: Rules = R) -> DataFrame:
    c = [F.col(x) for x in ("lead_year", "lead_period", "lead_week", "pos_year", "pos_period", "pos_week")]
    return pairs.withColumns({"gap": fiscal.gap(c[0], c[1], c[3], c[4], rules), "fiscal_class": fiscal.fiscal_class(*c, rules)})


def score_sets(pairs: DataFrame, names: list[str], addresses: list[str], rules: Rules = R) -> DataFrame:
    """Best of the sets of a name and an address score: set_scores, best_score, winning_set,
    name_score, address_score. Each score is a column, computed once; a missing one drops its sets,
    whichever name it is, and a name score that is not a number counts as 0."""
    clean = {n: F.when(F.col(n).isNotNull(), vectors.nan_as_zero(F.col(n))) for n in names}
    pairs = pairs.withColumns(clean)
    each = [scores.set_score(F.col(addresses[a]), F.col(names[n]), rules) for n, a in rules.sets]
    out = pairs.withColumn("__b", scores.best_set(each)).withColumns({"best_score": F.col("__b.score"), "winning_set": F.col("__b.set")}).drop("__b").where("best_score >= 0")
    pick = lambda which, cols: F.element_at(F.array(*[F.col(cols[s[which]]) for s in rules.sets]), F.col("winning_set"))
    return out.withColumns({"name_score": pick(0, names), "address_score": pick(1, addresses)})


def resolve(scored: DataFrame, rules: Rules = R, floor: float | None = None) -> DataFrame:
    """One lead for each transaction: the highest final_score at or above the floor, then the
    smallest lead_id; Manual Review if the next one is within the ambiguity, else Fuzzy."""
    w = Window.partitionBy("pos_id").orderBy(F.desc("final_score"), "lead_id")
    kept = scored.where(F.col("final_score") >= (rules.floor if floor is None else floor))
    kept = kept.withColumns({"n": F.row_number().over(w), "next_score": F.lead("final_score").over(w)}).where("n = 1").drop("n")
    close = F.col("next_score").isNotNull() & (F.round(F.col("final_score") - F.col("next_score"), 6) <= rules.ambiguity)
    return kept.withColumn("match_type", F.when(close, "Manual Review").otherwise("Fuzzy"))


def with_primary(df: DataFrame, rules: Rules = R, qualifies: Column | None = None) -> DataFrame:
    """Marks the earliest qualifying transaction of each lead by fiscal order, then pos_id."""
    ok = F.col("final_score") >= rules.floor if qualifies is None else qualifies
    w = Window.partitionBy("lead_id", F.coalesce(ok, F.lit(False))).orderBy("pos_year", "pos_period", F.coalesce("pos_week", F.lit(0)), "pos_id")
    return df.withColumn("primary_transaction", F.coalesce(ok, F.lit(False)) & (F.row_number().over(w) == 1))


def combine(exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """Exact pairs, and fuzzy ones whose lead and transaction no exact pair has."""
    rest = fuzzy.join(exact.select("lead_id"), "lead_id", "left_anti").join(exact.select("pos_id"), "pos_id", "left_anti")
    return exact.unionByName(rest, allowMissingColumns=True)


def debug_candidates(pairs: DataFrame, rules: Rules = R) -> DataFrame:
    """Every pair with its decision and the reason for it; none is dropped."""
    s, c = F.col("final_score"), F.col("fiscal_class")
    return pairs.withColumns({
        "decision": F.when(s.isNull(), "NO_EMBEDDING").when(c != "NORMAL", c).when(s >= rules.floor, "Potential").otherwise("No Match"),
        "reason": F.when(s.isNull(), "no vector").when(c == "CE", "transaction before the lead, within the window").when(c == "OAF", "transaction before the lead, beyond the window").when(s >= rules.floor, "score at or above the floor").otherwise("score below the floor"),
    })

"""Adaptive blocking: keys that give oversized blocks are refined twice, then given up.

Block sizes come from an aggregate joined back, not from a window: a key that holds a third of all
rows is then counted map-side and its join can be split, whereas a window would sort it in one task.
The sized rows of each stage are written to the shared folder, so no stage computes its upstream twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as t
from weftline.session import materialize
from weftline.settings import BlockingParams

ROW = ["kind", "bkey", "company_id"]


@dataclass
class Blocks:
    blocks: DataFrame
    heavy: DataFrame
    log: DataFrame
    tokens: DataFrame | None


def base_columns(companies: DataFrame) -> DataFrame:
    spaces = t.spaced(F.col("company_name"))
    return companies.select(
        F.col("company_id").cast("long").alias("company_id"),
        t.key(F.col("domain_name")).alias("domain"),
        t.key(F.col("city")).alias("city"),
        t.key(F.col("final_country")).alias("country"),
        spaces.alias("name_spaces"),
        F.regexp_replace(spaces, r"\s", "").alias("name_compact"),
    )


def _prefix_key(length: int, other: str) -> Column:
    name = F.col("name_compact")
    return F.when((F.length(name) >= length) & F.col(other).isNotNull(), F.concat(F.substring(name, 1, length), F.lit("|"), F.col(other)))


def _keys(df: DataFrame, keys: dict[str, Column], distinct: bool = True) -> DataFrame:
    """(kind, bkey, company_id) of all keys that aren't null, in one pass over df."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("bkey")) for k, c in keys.items()])
    out = df.select("company_id", F.explode(pairs).alias("k")).select("k.kind", "k.bkey", "company_id").filter("bkey IS NOT NULL")
    return out.dropDuplicates(ROW) if distinct else out


def _stage1_keys(p: BlockingParams) -> dict[str, Column]:
    keys = {}
    if p.use_domain:
        keys["domain"] = F.col("domain")
    if p.use_name3_country:
        keys["name3_country"] = _prefix_key(3, "country")
    if p.use_compact5_city:
        keys["compact5_city"] = _prefix_key(5, "city")
    return keys


def block_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "bkey").agg(F.count("*").alias("n"))


def _split(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    sized = materialize(rows.join(block_sizes(rows).filter("n >= 2"), ["kind", "bkey"]))
    kept = sized.filter(F.col("n").between(2, limit)).select(*ROW)
    big = sized.filter(F.col("n") > limit).select(*ROW, "n")
    return kept, big, big.select("kind", "bkey", "n").distinct()


def stage1_rows(companies: DataFrame, p: BlockingParams) -> DataFrame:
    return _keys(base_columns(companies), _stage1_keys(p))


def stage1_blocks(companies: DataFrame, p: BlockingParams) -> DataFrame:
    return _split(stage1_rows(companies, p), p.max_block_size)[0]


def all_block_sizes(companies: DataFrame, p: BlockingParams) -> DataFrame:
    """Sizes of the first keys before duplicates of a company go."""
    return block_sizes(_keys(base_columns(companies), _stage1_keys(p), distinct=False))


def _tokens(candidates: DataFrame, p: BlockingParams) -> DataFrame:
    """The rarest token of each candidate's name within its country; ties go to the smaller token."""
    words = candidates.filter("country IS NOT NULL").select("company_id", "country", F.explode(F.split("name_spaces", " ")).alias("tok"))
    words = words.filter((F.col("tok") != "") & (F.length("tok") >= p.stage3_min_token_len))
    if p.stage3_stopwords:
        words = words.filter(~F.col("tok").isin(list(p.stage3_stopwords)))
    df = words.groupBy("country", "tok").agg(F.count("*").alias("df"))
    best = words.join(df, ["country", "tok"]).groupBy("company_id").agg(F.min(F.struct("df", "tok", "country")).alias("m"))
    return best.select("company_id", F.col("m.country").alias("country"), F.col("m.tok").alias("tok"), F.col("m.df").alias("df"))


def adaptive_blocks(companies: DataFrame, p: BlockingParams) -> Blocks:
    base = base_columns(companies)
    kept1, big1, log1 = _split(_keys(base, _stage1_keys(p)), p.max_block_size)
    of = lambda rows, kind: base.join(rows.filter(F.col("kind") == kind).select("company_id").distinct(), "company_id", "left_semi")
    rows2 = _keys(of(big1, "name3_country"), {"name4_country": _prefix_key(4, "country")}) if p.use_name3_country else None
    if p.use_compact5_city:
        more = _keys(of(big1, "compact5_city"), {"compact7_city": _prefix_key(7, "city")})
        rows2 = rows2.unionByName(more) if rows2 is not None else more
    if p.use_domain and p.refine_domain_with_country:
        more = _keys(of(big1, "domain"), {"domain_country": F.when(F.col("domain").isNotNull(), F.concat("domain", F.lit("|"), "country"))})
        rows2 = rows2.unionByName(more) if rows2 is not None else more
    empty = kept1.limit(0)
    kept2, big2, log2 = _split(rows2 if rows2 is not None else empty, p.max_block_size)
    candidates = of(big2, "name4_country")
    parts, tokens = [], None
    if p.enable_stage3_token:
        tokens = _tokens(candidates, p)
        parts.append(tokens.select(F.lit("token_country").alias("kind"), F.concat("tok", F.lit("|"), "country").alias("bkey"), "company_id"))
    if p.enable_stage3_name6:
        parts.append(_keys(candidates, {"name6_country": _prefix_key(6, "country")}))
    if p.fallbacks:
        rest = candidates.join(tokens, "company_id", "left_anti") if tokens is not None else candidates
        parts.append(_keys(rest, {"name8_country": _prefix_key(8, "country"), "name6_city": _prefix_key(6, "city")}))
    rows3 = empty
    for x in parts:
        rows3 = x if rows3 is empty else rows3.unionByName(x)
    kept3, big3, log3 = _split(rows3, p.max_block_size)
    logs = [x.select(F.lit(stage).alias("stage"), "kind", "bkey", "n") for stage, x in (("stage1", log1), ("stage2", log2), ("stage3", log3))]
    return Blocks(kept1.unionByName(kept2).unionByName(kept3), big2.unionByName(big3), logs[0].unionByName(logs[1]).unionByName(logs[2]), tokens)

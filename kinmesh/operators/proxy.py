"""Synthetic linkage data and sampling, by hashes of ids and a seed: same rows on any cluster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tsv


@dataclass
class ProxyConfig:
    n_entities: int = 400
    singleton_rate: float = 0.40
    orphan_rate: float = 0.15
    large_rate: float = 0.06
    placeholder_name: float = 0.02
    placeholder_addr: float = 0.04
    branch_rate: float = 0.15
    unit_rate: float = 0.08
    max_per_vendor: int = 2
    france_test_only: bool = True
    seed: int = 20260925


@dataclass
class Proxy:
    frames: dict
    truth: DataFrame


def _u(seed: int, salt: str, *keys) -> Column:
    """A uniform number from 0 to 1 for the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(1_000_003)) / 1_000_003.0


def _choice(words: list[str], u: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (F.floor(u * len(words)) + 1).cast("int"))


HEADS = ["Amberfield", "Blue Anvil", "Old Pier", "Stonebridge", "Café Mistral", "Val d'Orée", "Sundaram", "Neelkanth", "Two Rivers", "Highgate", "Tamarind", "Frostline"]
TRADES = ["Logistics", "Printers", "Optics", "Furniture", "Dental", "Cycles", "Florists", "Seeds"]
STREETS = ["Station Street", "Mill Road", "Foundry Avenue", "Lakeside Boulevard", "Tilak Marg", "Gomti Nagar", "Rue des Tilleuls"]
FORMS = {"US": ["LLC", "Inc", "Corp"], "India": ["Pvt Ltd", "Private Limited", "LLP"], "France": ["SARL", "SAS", "SA"]}


def _vendor_name(name: Column, cfg: ProxyConfig, *keys) -> Column:
    u = _u(cfg.seed, "noise", *keys)
    swapped = F.concat(F.substring(name, 1, 1), F.substring(name, 3, 1), F.substring(name, 2, 1), F.expr("substring(name, 4)"))
    noisy = F.when(u < 0.2, F.upper(name)).when(u < 0.4, F.lower(name)).when(u < 0.6, swapped).when(u < 0.75, F.replace(name, F.lit("Private Limited"), F.lit("Pvt Ltd"))).otherwise(name)
    noisy = F.when(_u(cfg.seed, "branch", *keys) < cfg.branch_rate, F.concat(noisy, F.lit(" Branch"))).otherwise(noisy)
    noisy = F.when(_u(cfg.seed, "unit", *keys) < cfg.unit_rate, F.concat(noisy, F.lit(" #"), (F.floor(_u(cfg.seed, "no", *keys) * 90) + 1).cast("string"))).otherwise(noisy)
    return F.when(_u(cfg.seed, "pn", *keys) < cfg.placeholder_name, "NA").otherwise(noisy)


def _vendor_addr(addr: Column, cfg: ProxyConfig, *keys) -> Column:
    u = _u(cfg.seed, "addr", *keys)
    noisy = F.when(u < 0.3, F.replace(F.replace(addr, F.lit("Street"), F.lit("St")), F.lit("Road"), F.lit("Rd"))).when(u < 0.45, F.concat(addr, F.lit(", near the bus stand"))).when(u < 0.6, F.upper(addr)).otherwise(addr)
    return F.when(_u(cfg.seed, "pa", *keys) < cfg.placeholder_addr, "-").otherwise(noisy)


def generate(spark: SparkSession, cfg: ProxyConfig | None = None) -> Proxy:
    cfg = cfg or ProxyConfig()
    e = spark.range(cfg.n_entities).repartition(4, "id")
    i = F.col("id")
    country = _choice(list(FORMS), _u(cfg.seed, "country", i))
    e = e.withColumn("country", country)
    form = F.when(F.col("country") == "US", _choice(FORMS["US"], _u(cfg.seed, "form", i))).when(F.col("country") == "India", _choice(FORMS["India"], _u(cfg.seed, "form", i))).otherwise(_choice(FORMS["France"], _u(cfg.seed, "form", i)))
    chain = F.when(_u(cfg.seed, "chain", i) < 0.12, F.floor(i / 10).cast("long")).otherwise(i)
    pin = F.when(F.col("country") == "India", (F.lit(400000) + F.floor(_u(cfg.seed, "pin", i) * 99999)).cast("string")).otherwise((F.lit(10000) + F.floor(_u(cfg.seed, "pin", i) * 89999)).cast("string"))
    s1 = e.select(
        "id",
        F.concat(F.lit("S1-"), F.lpad(i.cast("string"), 5, "0")).alias("entity_id"),
        F.concat_ws(" ", _choice(HEADS, _u(cfg.seed, "head", chain)), _choice(TRADES, _u(cfg.seed, "trade", chain)), form).alias("name"),
        F.concat(F.floor(_u(cfg.seed, "house", i) * 890 + 10).cast("string"), F.lit(" "), _choice(STREETS, _u(cfg.seed, "street", i)), F.lit(", "), pin).alias("addr"),
        "country",
    )
    single, large = _u(cfg.seed, "single", i) < cfg.singleton_rate, _u(cfg.seed, "large", i) < cfg.large_rate
    n = F.when(single, 0).when(large, 6).otherwise(1 + F.floor(_u(cfg.seed, "n", i) * cfg.max_per_vendor)).cast("int")
    frames = {"S1": s1.select("entity_id", F.col("name").alias("business_name"), F.col("addr").alias("business_address"), "country")}
    truth = None
    for v in ("S2", "S3"):
        keys = (F.lit(v), F.col("id"), F.col("j"))
        own = s1.withColumn("j", F.explode(F.sequence(F.lit(1), n + 1))).filter(F.col("j") <= n)
        own = own.select(F.concat(F.lit(f"{v}-"), F.lpad(F.col("id").cast("string"), 5, "0"), F.col("j").cast("string")).alias("frag_id"), F.col("entity_id").alias("s1_id"), _vendor_name(F.col("name"), cfg, *keys).alias("business_name"), _vendor_addr(F.col("addr"), cfg, *keys).alias("business_address"), "country")
        lost = s1.filter(_u(cfg.seed, "orphan", F.lit(v), F.col("id")) < cfg.orphan_rate / 2)
        lost = lost.select(F.concat(F.lit(f"{v}-9"), F.lpad(F.col("id").cast("string"), 5, "0")), F.lit(None).cast("string"), F.concat(F.lit("Orphan "), _choice(TRADES, _u(cfg.seed, v, F.col("id")))), F.concat(F.col("id").cast("string"), F.lit(" Quay Lane")), "country")
        both = own.union(lost)
        frames[v] = both.select(F.col("frag_id").alias("entity_id"), "business_name", "business_address", "country")
        pairs = both.filter("s1_id is not null").select("s1_id", "frag_id")
        truth = pairs if truth is None else truth.union(pairs)
    return Proxy(frames, truth)


def split_train_test(proxy: Proxy, cfg: ProxyConfig | None = None) -> tuple[Proxy, Proxy]:
    """France only in the test part, if the configuration says so; orphans of other countries stay in training."""
    cfg = cfg or ProxyConfig()
    french = F.col("country") == "France"
    half = F.pmod(F.xxhash64("entity_id", F.lit(cfg.seed)), F.lit(2)) == 0
    test_ids = proxy.frames["S1"].filter(french | half if cfg.france_test_only else half).select("entity_id")
    out = []
    for how in ("left_anti", "left_semi"):
        s1 = proxy.frames["S1"].join(test_ids, "entity_id", how)
        truth = proxy.truth.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        own = truth.select(F.col("frag_id").alias("entity_id"))
        matched = proxy.truth.select(F.col("frag_id").alias("entity_id"))
        frames = {"S1": s1}
        for v in ("S2", "S3"):
            orphans = proxy.frames[v].join(matched, "entity_id", "left_anti").filter(~french if how == "left_anti" else french)
            frames[v] = proxy.frames[v].join(own, "entity_id", "left_semi").union(orphans)
        out.append(Proxy(frames, truth))
    return out[0], out[1]


def build(spark: SparkSession, folder: str, cfg: ProxyConfig | None = None) -> dict[str, str]:
    """Write both parts as sources with their ground truth; phase -> folder."""
    out = {}
    for phase, part in zip(("train", "test"), split_train_test(generate(spark, cfg), cfg)):
        out[phase] = f"{folder}/{phase}"
        for n, name in enumerate(("S1", "S2", "S3"), 1):
            tsv.write_source(part.frames[name], f"{out[phase]}/source{n}.tsv")
        tsv.write_truth(part.truth, f"{out[phase]}/ground_truth.tsv")
    return out


def sample(s1: DataFrame, frags: DataFrame, truth: DataFrame, n: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """n masters by hash, exactly their true fragments, and for each vendor n // 2 fragments of others."""
    order = F.xxhash64("entity_id", F.lit(seed))
    masters = s1.orderBy(order, "entity_id").limit(n)
    wanted = truth.join(masters.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(F.col("frag_id").alias("entity_id"))
    out = frags.join(wanted, "entity_id", "left_semi")
    rest = frags.join(wanted, "entity_id", "left_anti")
    for v in ("S2", "S3"):
        out = out.union(rest.filter(F.col("entity_id").startswith(f"{v}-")).orderBy(order, "entity_id").limit(n // 2))
    return masters, out

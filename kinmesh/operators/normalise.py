"""The normalised-record contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

FIELDS = ["name_norm", "name_core", "name_tokens", "name_core_ascii", "addr_norm", "addr_ascii", "addr_numbers", "postcode", "landmark_flag", "script_flag", "legal_suffixes", "suffix_countries", "phonetic_key", "country_norm", "name_missing", "addr_missing"]

RAW = ("business_name", "business_address", "country")


def normalise(df: DataFrame, extra_placeholders: list[str] | None = None, texts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """entity_id and the sixteen fields of a normalised record.  Further columns are kept.

    Placeholders give empty norms and nothing parsed from them; the raw text still says
    which scripts it is written in, and the country label is kept whatever it is.

    Names and addresses repeat, so each distinct name, and each distinct address with its
    country, is worked out once and joined to the records.  texts: `worked_out` of sources
    that hold df's."""
    own = [c for c in df.columns if c not in RAW]
    raw = df.select(*own, *_blank_if_null())
    names, addresses = texts or worked_out([df], extra_placeholders)
    x = raw.join(names, "_business_name").join(addresses, ["_business_address", "_country"])
    return x.withColumn("script_flag", T.script_of(F.col("_name_scripts"), F.col("_addr_scripts"))).select(*own, *FIELDS)


def worked_out(sources: list[DataFrame], extra_placeholders: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Each distinct name, and each distinct address with its country, of all the sources."""
    raw = reduce(DataFrame.union, [df.select(*_blank_if_null()) for df in sources])
    return _names(_distinct(raw, "_business_name"), extra_placeholders), _addresses(_distinct(raw, "_business_address", "_country"), extra_placeholders)


def parsed(df: DataFrame, names: DataFrame, addresses: DataFrame) -> DataFrame:
    """entity_id and what `names` and `addresses` say of a record; records of names or addresses that these lack go."""
    raw = df.select("entity_id", *_blank_if_null())
    return raw.join(names, "_business_name").join(addresses, ["_business_address", "_country"])


def _blank_if_null() -> list[Column]:
    return [F.coalesce(c, F.lit("")).alias(f"_{c}") for c in RAW]


def _distinct(raw: DataFrame, *columns: str) -> DataFrame:
    """Distinct values over as many partitions as a shuffle has: a row costs far more than its bytes tell.
    They are dealt by a hash, not by the columns, else the exchange of distinct() serves, which may be coalesced."""
    return _worked_out(raw.select(*columns).distinct(), F.xxhash64(*columns))


def _worked_out(df: DataFrame, *keys: str | Column) -> DataFrame:
    """df behind an exchange: what follows reads its columns as values.  Without one, Spark writes an
    expression into all that use it, and computes it anew in each place."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _names(names: DataFrame, extra: list[str] | None) -> DataFrame:
    raw = F.col("_business_name")
    x = names.select(raw, T.nfkc_casefold(raw).alias("_name"), T.scripts(raw).alias("_name_scripts"))
    x = x.withColumn("name_missing", T.placeholder(F.col("_name"), extra))
    x = x.withColumn("name_norm", F.when(F.col("name_missing"), "").otherwise(T.normalise_name(F.col("_name"))))
    x = _worked_out(x, "_business_name").withColumn("legal_suffixes", T.legal_suffixes(F.col("name_norm")))
    x = _worked_out(x, "_business_name").withColumn("name_core", T.strip_suffixes(F.col("name_norm"), F.col("legal_suffixes")))
    parsed = {
        "name_tokens": T.name_tokens(F.col("name_core")),
        "suffix_countries": T.suffix_countries(F.col("legal_suffixes")),
        "name_core_ascii": T.fold_ascii(F.col("name_core")),
        "phonetic_key": T.phonetic_key(F.col("name_core")),
    }
    return _worked_out(x, "_business_name").withColumns(parsed).drop("_name")


def _addresses(addresses: DataFrame, extra: list[str] | None) -> DataFrame:
    raw = F.col("_business_address")
    x = addresses.select(raw, "_country", T.nfkc_casefold(raw).alias("_addr"), T.one_space(T.nfkc_casefold(F.col("_country"))).alias("country_norm"), T.scripts(raw).alias("_addr_scripts"))
    x = x.withColumn("addr_missing", T.placeholder(F.col("_addr"), extra))
    x = x.withColumn("addr_norm", F.when(F.col("addr_missing"), "").otherwise(T.normalise_address(F.col("_addr"))))
    parsed = {
        "addr_numbers": T.numbers(F.col("addr_norm")),
        "postcode": T.postcode(F.col("addr_norm"), F.col("country_norm")),
        "landmark_flag": T.landmark(F.col("addr_norm")),
        "addr_ascii": T.fold_ascii(F.col("addr_norm")),
    }
    return _worked_out(x, "_business_address", "_country").withColumns(parsed).drop("_addr")

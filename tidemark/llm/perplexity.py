"""Quality by perplexity: an interpolated modified Kneser-Ney model of characters, from trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import grouped_quantiles
from ..operators.quantiles import exact_quantiles
from ..session import durable

#: Bits of a character in a gram; characters beyond the first plane share one sign.
BITS, WIDE = 16, 0xFFFF
#: Stands before a text's first character.
BEFORE = 1
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0], dtype=np.uint32)


def text_grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all characters of the texts, as 64-bit numbers, and the texts' bounds.

    Runs of white space count as one space.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    space = np.isin(points, _SPACES)
    codes = np.where(space, 32, np.minimum(points, WIDE)).astype(np.uint64)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    codes, owner = codes[keep], owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(codes)) - bounds[:-1][owner]
    grams = codes.copy()
    for back in range(1, order):
        earlier = np.full(len(codes), BEFORE, dtype=np.uint64)
        inside = place >= back
        earlier[inside] = codes[np.flatnonzero(inside) - back]
        grams |= earlier << np.uint64(BITS * back)
    return grams.view(np.int64), bounds


def context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def suffix(gram: Column, order: int) -> Column:
    """The last ``order`` characters of a gram."""
    return gram if BITS * order >= 64 else gram.bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def _parts(batches: Iterator[pd.DataFrame], limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Batches cut to about ``limit`` characters."""
    for batch in batches:
        held = batch["t"].str.len().cumsum() // limit
        for _, part in batch.groupby(held.to_numpy()):
            yield part


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order, from the numbers of grams that occur 1 to 4 times."""
    n = counts.agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (n[f"n{i}"] or 0 for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, (3 - 4 * y * n4 / n3) if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1))


def kneser_ney(counts: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 up: ``g, p`` of seen grams, and ``h, left`` of contexts (the mass for unseen ones).

    The top order uses occurrences, the others the number of different
    characters before a gram.  Grams are joined with their contexts and with
    their shorter grams, all by hash, so the tables may grow with the corpus.
    """
    tables = [durable(counts)]
    for k in range(order - 1, 0, -1):
        tables.append(durable(tables[-1].groupBy(suffix(F.col("g"), k).alias("g")).agg(F.count("*").alias("c"))))
    tables.reverse()
    model: list[tuple[DataFrame, DataFrame]] = []
    size = tables[0].count() + 1  # one more for characters never seen
    for k, table in enumerate(tables, 1):
        d1, d2, d3 = discounts(table)
        c = F.col("c")
        stats = durable(
            table.groupBy(context(F.col("g")).alias("h")).agg(
                F.sum("c").alias("total"),
                ((d1 * F.count_if(c == 1) + d2 * F.count_if(c == 2) + d3 * F.count_if(c >= 3)) / F.sum("c")).alias("left"),
            )
        )
        own = F.greatest(c - F.when(c == 1, d1).when(c == 2, d2).otherwise(d3), F.lit(0.0)) / F.col("total")
        joined = table.select("g", "c", context(F.col("g")).alias("h")).join(stats, "h")
        if k == 1:
            seen = joined.select("g", (own + F.col("left") / size).alias("p"))
        else:
            shorter = model[-1][0].select(F.col("g").alias("s"), F.col("p").alias("q"))
            seen = (
                joined.withColumn("s", suffix(F.col("g"), k - 1))
                .join(shorter, "s")
                .select("g", (own + F.col("left") * F.col("q")).alias("p"))
            )
        model.append((durable(seen), stats.select("h", "left")))
    return model


def look_up(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]], order: int) -> DataFrame:
    """``g, logp`` of grams, backing off through the orders; ``wanted`` has distinct ``g``."""
    size = model[0][0].count() + 1
    found = wanted.select("g")
    known: Column = F.lit(None).cast("double")
    for k, (seen, contexts) in enumerate(model, 1):
        found = (
            found.withColumns({"s": suffix(F.col("g"), k), "h": context(suffix(F.col("g"), k))})
            .join(seen.select(F.col("g").alias("s"), F.col("p").alias(f"p{k}")), "s", "left")
            .join(contexts.withColumnRenamed("left", f"left{k}"), "h", "left")
            .drop("s", "h")
        )
        below = F.lit(1.0 / size) if k == 1 else known
        known = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"left{k}"), F.lit(1.0)) * below)
    return found.select("g", F.log(known).alias("logp"))


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    order: int = 4,
    quantile: float = 0.99,
    slack: float = 1.0,
    held_out: int = 5,
    block_bytes: int = 16 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, kept`` for every row of ``docs``.

    Trusted documents are those whose number is in ``trusted`` (column
    ``doc_id``).  One in ``held_out`` of them, by a hash of the number, is kept
    back; the model is trained on the whole texts of all the others.  Texts are dealt to blocks of about
    ``block_bytes`` by a hash of number and text; a block tells once of each gram that it holds how
    often its training texts have it.  The sums of these counts are the model's
    tables; the distinct grams of all blocks are joined with them, shard by
    shard, and each block scores its texts with the answers.  A document is kept if its
    perplexity per character is at most the ``quantile`` (times ``slack``, if given) of the
    held-out documents of its language (a model knows its own training text too
    well); a language without any takes the quantile of all of them.

    Null and empty texts have no perplexity and are not kept.  A null language is
    a language of its own.  Rows without a number are scored but never trusted;
    rows that repeat a number are scored one by one.  Without trusted text
    nothing is known and every text with a character is kept.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("t_id")).where("t_id is not null").distinct()
    is_out = F.pmod(F.xxhash64(F.lit("held out"), "t_id"), F.lit(held_out)) == 0
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(lang), F.lit("")).alias("l"), F.col(lang).alias("lang"), F.col(text).alias("t")
    )
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    # by number and text, so that rows of one number do not fill a block
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(blocks)))
    filled = dealt.where(F.length("t") > 0)
    training = (
        filled.select(F.col("block").alias("of"), F.col("id").alias("own"))
        .join(ids.where(~is_out), F.col("own") == F.col("t_id"), "left_semi")
        .distinct()
        .select(F.col("of").alias("block"), F.col("own").alias("t_id"))
    )

    def ask(key, texts: pd.DataFrame, taught: pd.DataFrame) -> pd.DataFrame:
        """The distinct grams of a block, and how often its training texts hold each."""
        grams, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for part in _parts(iter([texts])):
            found, bounds = text_grams(part["t"].tolist(), order)
            counted = np.repeat(part["id"].isin(taught["t_id"]).to_numpy(), np.diff(bounds))
            codes, values = pd.factorize(found)
            own = np.bincount(codes[counted], minlength=len(values))
            codes, grams = pd.factorize(np.concatenate([grams, values]))
            counts = np.bincount(codes, weights=np.concatenate([counts, own]), minlength=len(grams)).astype(np.int64)
        return pd.DataFrame({"block": key[0], "g": grams, "c": counts})

    asked = durable(
        filled.select("block", F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "t").groupBy("block").cogroup(training.groupBy("block")).applyInPandas(ask, "block long, g long, c long")
    )
    counts = asked.where("c > 0").groupBy("g").agg(F.sum("c").alias("c"))
    model = kneser_ney(counts, order)
    answers = durable(look_up(asked.select("g").distinct(), model, order))
    replies = asked.select("block", "g").join(answers, "g").select("block", "g", F.col("logp").cast("float").alias("logp"))

    def score(key, texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        index, logp = pd.Index(known["g"].to_numpy()), known["logp"].to_numpy(dtype="float64")
        out = []
        for part in _parts(iter([texts])):
            grams, bounds = text_grams(part["t"].tolist(), order)
            values = logp[index.get_indexer(grams)] if len(grams) else np.empty(0)
            sums = np.add.reduceat(values, bounds[:-1]) if len(values) else np.empty(0)
            out.append(part[["id", "l", "lang"]].assign(perplexity=np.exp(-sums / np.diff(bounds))))
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "l", "lang", "perplexity"])

    scored = (
        filled.withColumn("id", F.col("id").cast("string"))  # beside nulls pandas would make numbers doubles
        .groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInPandas(score, "id string, l string, lang string, perplexity double")
        .withColumn("id", F.col("id").cast("long"))
    )
    empty = rows.where("t is null or length(t) = 0").select("id", "l", "lang", F.lit(None).cast("double").alias("perplexity"))
    scored = durable(scored.union(empty))
    of_trusted = scored.join(ids.where(is_out), F.col("id") == F.col("t_id"), "left_semi").where("perplexity is not null")
    by_lang = durable(grouped_quantiles(of_trusted, ["l"], "perplexity", {"own": quantile}))
    (overall,) = exact_quantiles(of_trusted, {"perplexity": [quantile]})["perplexity"]
    threshold = slack * F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return scored.join(by_lang, "l", "left").select(
        F.col("id").alias("doc_id"),
        "lang",
        "perplexity",
        threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"),
    )

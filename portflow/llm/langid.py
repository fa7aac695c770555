"""Language identification by Bayesian evidence fusion.

Of each page, four things speak: how likely its text is under a byte-trigram model of each language; the language its
markup declares; the suffix of its address; and its host. The last three are weighed by what the text alone says of all
other pages, in grouped aggregations: how often a declaration or a suffix goes with a language, and the shares of the
languages on a host, smoothed towards those of its domain, which are smoothed towards those of all pages. A page's own
vote is taken out of all counts that it is held against, so that its text speaks once.

A text is of none of the languages, and its page `und`, if even the best model finds its trigrams less likely than
BACKGROUND, that is trigrams spread evenly over all codes: foreign scripts, languages not fitted and junk. It has no vote.

A page without letters, a null text and an empty one have no text evidence; the rest decides, and `und` is the answer
if nothing lifts a language over `least`. Null declarations, suffixes, domains and hosts say nothing, nor do those that no
other page with a vote has. Ties go to the language that comes first by name. Repeated pages vote as often as they occur.
Other columns of documents are kept, whatever they are called; those of pages are ignored. The text model is fitted on
at most `per_language` labelled texts of each language, those of the smallest hash; equal texts count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.shared import written

PER_LANGUAGE, CODES = 2000, 1 << 14
#: Trigrams of a text overlap and repeat, so that n of them count as EVIDENCE * ln(1 + n / EVIDENCE) independent ones: all of
#: few, ever fewer of many, and more for every further one.
EVIDENCE, LEAST, SMOOTHING = 40.0, 0.5, 10.0
#: Parts in which a language's smallest hashes are found before they meet.
SALTS = (32, 4)
#: Copies of a table that rows are joined to by a key which many of them may share.
JOIN_SALTS = 16
#: Log-likelihood of a trigram in a text of no fitted language.
BACKGROUND = -float(np.log(CODES))


def trigram_codes(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text, all but letters taken as one separator."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else text.lower()
    b = np.frombuffer(f" {kept} ".encode(), np.uint8).astype(np.uint32)
    b = np.where((b < 97) | (b > 122) & (b < 128), 32, b)
    h = (b[:-2] * 2654435761 + b[1:-1] * 40503 + b[2:] * 69069) & 0xFFFFFFFF
    letters = (b[:-2] != 32).astype(np.uint8) + (b[1:-1] != 32) + (b[2:] != 32)
    return ((h ^ h >> 15) & (CODES - 1))[letters >= 2].astype(np.int64)


def fit_text_model(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """From (text, lang): the languages and their log-probabilities of each code. At most languages x CODES sums are collected."""
    some = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    # the smallest hashes, found on narrow rows and in ever fewer parts: at most 4 x per_language of a language meet
    least = some.select("lang", "h").distinct()
    for parts in (*SALTS, 1):
        part = Window.partitionBy("lang", F.pmod(F.col("h"), F.lit(parts))).orderBy("h")
        least = least.withColumn("k", F.row_number().over(part)).where(F.col("k") <= per_language).select("lang", "h")
    some = some.join(F.broadcast(least), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("lang", "text")  # languages x per_language numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(lang, np.zeros(CODES, np.int64))
                sums[lang] += np.bincount(trigram_codes(text), minlength=CODES)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "code", "n"])

    sums = some.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    langs = sorted(found["lang"].unique())
    n = np.full((len(langs), CODES), 0.5)
    np.add.at(n, (np.searchsorted(langs, found["lang"].to_numpy(object)), found["code"].to_numpy()), found["n"].to_numpy()) if langs else None
    return langs, np.log(n / n.sum(axis=1, keepdims=True))


def weighed(n: int, evidence: float = EVIDENCE) -> float:
    """How many independent trigrams n of a text count as."""
    return evidence * float(np.log1p(n / evidence))


def score_text(pages: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", evidence: float = EVIDENCE) -> DataFrame:
    """pages with `ll`: for each language the log-likelihood of the text, null without letters; `foreign`: it is of none of them."""
    shared = pages.sparkSession.sparkContext.broadcast(model[1])  # languages x CODES numbers
    columns = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            out, foreign = [], []
            for t in (x.as_py() for x in batch.column(text)):  # one text at a time
                c = trigram_codes(t or "")
                mean = (np.bincount(c, minlength=CODES) @ p.T if len(c) > 8 * CODES else p[:, c].sum(axis=1)) / len(c) if len(c) else None
                out.append(None if mean is None else mean * weighed(len(c), evidence))
                foreign.append(bool(mean is not None and len(p) and mean.max() < BACKGROUND))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64())), pa.array(foreign, pa.bool_())], [*columns, "ll", "foreign"])

    return pages.mapInArrow(run, pages.select("*", F.lit(None).cast("array<double>").alias("ll"), F.lit(None).cast("boolean").alias("foreign")).schema)


def _shares(n: F.Column, towards: F.Column) -> F.Column:
    """Shares of the languages in the counts n, smoothed."""
    total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(n, towards, lambda x, t: (x + F.lit(SMOOTHING) * t) / (total + F.lit(SMOOTHING)))


def _joined(rows: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """rows with counts (by, n_<last of by>), salted: a host or suffix may have any share of the rows."""
    named = counts.select(*(F.col(c).alias(f"_{c}") for c in by), f"n_{by[0]}", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))).alias("_copy"))
    on = [F.col(by[0]) == F.col(f"_{by[0]}"), F.col("_salt") == F.col("_copy"), *(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by[1:])]
    return rows.join(named, on, "left").drop("_copy", *(f"_{c}" for c in by))


def fuse(scored: DataFrame, langs: list[str], least: float = LEAST) -> DataFrame:
    """scored (key, host, domain, suffix, declared, ll, and foreign if known) with text_lang, lang_found, confidence."""
    foreign = F.coalesce("foreign", F.lit(False)) if "foreign" in scored.columns else F.lit(False)
    if not langs:  # no labelled text at all
        return scored.withColumns({"text_lang": F.lit(None).cast("string"), "lang_found": F.lit("und"), "confidence": F.lit(0.0)})
    names = F.array(*map(F.lit, langs))
    scored = scored.withColumn("text_lang", F.when(F.col("ll").isNotNull() & ~foreign, F.element_at(names, F.array_position("ll", F.array_max("ll")).cast("int"))))
    votes = scored.where("text_lang is not null").groupBy("host", "domain", "suffix", "declared", "text_lang")
    cube = written(votes.agg(F.count("*").cast("double").alias("votes")))

    def summed(*by: str) -> DataFrame:
        """by, n: the votes for each language. What has no vote is not there."""
        each = cube.where(F.col(by[0]).isNotNull()).groupBy(*by, "text_lang").agg(F.sum("votes").alias("votes"))
        each = each.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("text_lang", "votes"))).alias("of"))  # languages entries at most
        return each.select(*by, F.transform(names, lambda x: F.coalesce(F.try_element_at("of", x), F.lit(0.0))).alias(f"n_{by[0]}"))

    whole = {r["text_lang"]: r["votes"] for r in cube.groupBy("text_lang").agg(F.sum("votes").alias("votes")).collect()}  # one row a language
    out = scored.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(JOIN_SALTS)).cast("int"))
    for by in (["host", "domain"], ["domain"], ["declared"], ["suffix"]):
        out = _joined(out, summed(*by), by)
    # a page's own vote out of every count
    own = F.transform(names, lambda x: F.when(x == F.col("text_lang"), 1.0).otherwise(0.0))
    without = lambda n: F.zip_with(n, F.col("_own"), lambda x, o: x - o)
    some = lambda n: F.exists(n, lambda x: x > 0)
    out = out.withColumn("_own", own).withColumn("n_all", without(F.array(*(F.lit(whole.get(x, 0.0)) for x in langs))))
    for by in ("host", "domain", "declared", "suffix"):
        n = without(F.col(f"n_{by}"))
        out = out.withColumn(f"n_{by}", F.when(some(n), n))
    total = F.aggregate("n_all", F.lit(float(len(langs))), lambda a, x: a + x)
    out = out.withColumn("of_all", F.transform("n_all", lambda x: (x + 1.0) / total))
    out = out.withColumn("of_domain", F.coalesce(F.when(F.col("n_domain").isNotNull(), _shares(F.col("n_domain"), F.col("of_all"))), "of_all"))
    out = out.withColumn("of_host", F.coalesce(F.when(F.col("n_host").isNotNull(), _shares(F.col("n_host"), F.col("of_domain"))), "of_domain"))
    post = F.zip_with(F.coalesce("ll", F.array(*[F.lit(0.0)] * len(langs))), "of_host", lambda a, p: a + F.log(p))
    out = out.withColumn("post", post)
    for by in ("declared", "suffix"):
        # P(what is seen | language), up to a factor that is the same for all languages
        seen = F.zip_with(F.arrays_zip("n_all", "of_all"), f"n_{by}", lambda a, x: F.log((x + F.lit(SMOOTHING) * a["of_all"]) / (a["n_all"] + F.lit(SMOOTHING))))
        out = out.withColumn("post", F.when(F.col(f"n_{by}").isNull(), F.col("post")).otherwise(F.zip_with("post", seen, lambda a, p: a + p)))
    out = out.withColumn("top", F.array_max("post"))
    out = out.withColumn("confidence", F.lit(1.0) / F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    known = (F.col("confidence") >= least) & ~foreign & F.coalesce("ll", "n_declared", "n_suffix", "n_host", "n_domain").isNotNull()
    out = out.withColumn("lang_found", F.when(known, F.element_at(names, F.array_position("post", F.col("top")).cast("int"))).otherwise("und"))
    return out.drop("post", "top", "_own", "_salt", "of_all", "of_host", "of_domain", "n_all", "n_host", "n_domain", "n_declared", "n_suffix")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, host, domain, suffix, declared, text) of pages (page_id, url, html).

    A script, style or comment without an end goes on to the end of the page, as in browsers; a `<` without a `>` before the next
    `<` is text. No pattern looks at a character from more than a few starts, so that time is in proportion to the page, whatever is in it.
    """
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1))
    html = F.coalesce(F.col("html"), F.lit(""))
    declared = F.lower(F.regexp_extract(html, r"""(?i)<html(?=[\s>/])[^<>]*\blang=["']?([a-zA-Z]{2,3})""", 1))
    hidden = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1>|\z)|<!--.*?(?:-->|\z)", " ")
    plain = F.regexp_replace(hidden, r"(?s)<[^<>]*+>|&[#a-zA-Z0-9]++;", " ")
    out = pages.select("page_id", F.nullif(host, F.lit("")).alias("host"), F.nullif(declared, F.lit("")).alias("declared"), plain.alias("text"))
    domain = F.when(F.contains("host", F.lit(".")), F.substring_index("host", ".", -2))
    return out.withColumns({"domain": domain, "suffix": F.substring_index("host", ".", -1)})


def identify_pages(pages: DataFrame, model: tuple[list[str], np.ndarray], least: float = LEAST) -> DataFrame:
    found = fuse(written(score_text(page_evidence(pages), model).drop("text")), model[0], least)
    return found.select("page_id", "host", "suffix", "declared", "text_lang", F.col("lang_found").alias("lang"), F.round("confidence", 6).alias("confidence"))


def identify_documents(docs: DataFrame, model: tuple[list[str], np.ndarray], least: float = LEAST) -> DataFrame:
    """docs with text_lang, lang_found and confidence; the source is the host, and nothing is declared."""
    nothing = F.lit(None).cast("string")
    given = [c for c in docs.columns if c not in ("text_lang", "lang_found", "confidence")]
    held = {c: f"_{i}" for i, c in enumerate(given) if c != "text"}  # whatever they are called, they don't clash
    rows = docs.select(*given).withColumnsRenamed(held).withColumns({"host": F.col(held["source"]), "domain": nothing, "suffix": nothing, "declared": nothing})
    out = fuse(score_text(rows, model), model[0], least)
    return out.select(*(F.col(held.get(c, c)).alias(c) for c in given), "text_lang", "lang_found", "confidence")

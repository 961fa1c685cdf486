"""Terms of a table found in texts, by equi-joins.

Terms of letters and digits only lie within words, so they are looked for in the distinct words of all texts,
and texts meet the words that hold one. Other terms are looked up in the texts. Either look-up is an equi-join
on the rarest n-gram of each term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import news
from ..session import stored

GRAM = 3  # characters that are looked up
WORD = r"[\p{L}\p{N}]"


def _grams(text: Column, n: int) -> Column:
    """The distinct runs of n characters."""
    # read from an array, as finding a character in the text would walk the text each time; the array
    # is bound to a name, so that it is made once
    runs = F.transform(F.array(F.split(text, "")), lambda letters: F.transform(
        letters, lambda c, i: F.concat(c, *(F.get(letters, i + k) for k in range(1, n)))))
    return F.when(F.length(text) >= n, F.array_distinct(F.array_compact(F.get(runs, F.lit(0)))))


def _sized(text: Column, sizes: list[int]) -> Column:
    none = F.array().cast("array<string>")
    return F.explode(F.concat(*(F.coalesce(_grams(text, n), none) for n in sizes)))


def match_terms(texts: DataFrame, terms: DataFrame, key: str, text: str, term: str = "term",
                whole_word: bool = False) -> DataFrame:
    """``key`` and ``term`` of every text that contains a term, each once; case does not count.

    ``key`` names the rows of ``texts``. Terms of letters and digits are looked up in the distinct words of all
    texts, which are far fewer than their places; texts then meet the words that hold a term by equality.
    Every other term is looked up by one of its runs of three characters (the whole term if it is shorter), the
    one that is in fewest texts, and verified on the whole text. The terms may be as many as a table
    holds: nothing is compared with all of them. Null texts and empty or null terms match nothing.
    """
    known = terms.select(F.lower(term).alias("_term")).where("length(_term) > 0").distinct().withColumns({
        "_plain": F.regexp_like("_term", F.lit(f"^{WORD}+$")), "_size": F.least(F.length("_term"), F.lit(GRAM))})
    known = stored(known, "terms")
    kinds = known.groupBy("_plain", "_size").agg(F.min(F.length("_term")).alias("least")).collect()  # 6 at most
    found = texts.select(F.col(key).alias("_key"), F.lower(text).alias("_text")).where("_text is not null")
    met = found.select("_key", F.lit("").alias("_term")).where(F.lit(False))
    if sizes := sorted(r._size for r in kinds if not r._plain):
        met = _by_grams(found, known.where("not _plain"), sizes, whole_word)
    if sizes := sorted(r._size for r in kinds if r._plain):
        least = min(r.least for r in kinds if r._plain)
        words = found.select("_key", F.explode(F.array_distinct(
            F.split("_text", r"[^\p{L}\p{N}]+"))).alias("_word")).where(F.length("_word") >= least)
        plain = known.where("_plain")
        if whole_word:
            held = plain.select(F.col("_term").alias("_word"), "_term")
        else:
            own = stored(words.select("_word").distinct(), "words")
            held = _by_grams(own.select(F.col("_word").alias("_key"), F.col("_word").alias("_text")), plain, sizes,
                             False).select(F.col("_key").alias("_word"), "_term")
            held = stored(held, "words-of-terms")  # so that its size is known when the join is planned
        in_words = words.join(held, "_word").select("_key", "_term")
        met = in_words if len(kinds) == len(sizes) else met.unionAll(in_words)
    return met.select(F.col("_key").alias(key), F.col("_term").alias(term)).distinct()


def _by_grams(found: DataFrame, known: DataFrame, sizes: list[int], whole_word: bool) -> DataFrame:
    """_key and _term of the texts (_key, _text) that contain a term (_term, _size), equal ones more than once."""
    of_term = known.select("_term", F.explode(F.array_distinct(F.flatten(F.array(*(
        F.when(F.col("_size") == n, _grams(F.col("_term"), n)).otherwise(F.array().cast("array<string>"))
        for n in sizes))))).alias("_gram"))
    asked = of_term.select("_gram").distinct()
    in_texts = found.select("_key", _sized(F.col("_text"), sizes).alias("_gram"))
    # a term one of whose runs is in no text is in none either
    counted = in_texts.join(asked, "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = (of_term.join(counted, "_gram", "left").groupBy("_term")
              .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("x"))
              .where("x.n > 0").select("_term", F.col("x._gram").alias("_gram")))
    pairs = in_texts.join(rarest, "_gram").select("_key", "_term")
    holds = F.col("_text").contains(F.col("_term"))
    if whole_word:
        holds &= F.regexp_like("_text", F.concat(F.lit(rf"(?<!{WORD})\Q"), "_term", F.lit(rf"\E(?!{WORD})")))
    return pairs.join(found, "_key").where(holds).select("_key", "_term")


def classify_by_terms(df: DataFrame, key: str, keywords: DataFrame, routes: DataFrame, title: str = "title",
                      description: str = "description", whole_word: bool = False) -> DataFrame:
    """``classify_news`` with the words in tables: ``keywords`` (term), ``routes`` (term, route, place).

    Routes are listed in the order of ``place``. ``key`` names the articles.
    """
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))
    words = keywords.select(F.lower("term").alias("term")).withColumn("_risk", F.lit(True))
    own = routes.select(F.lower("term").alias("term"), "route", "place")
    met = match_terms(df.withColumn("_whole", text), words.select("term").union(own.select("term")), key, "_whole",
                      whole_word=whole_word)
    # both tables meet what was found in one pass; a route without a name is none, as in the list
    told = words.distinct().select("term", "_risk", F.lit(None).cast(own.schema["route"].dataType).alias("route"),
                                   F.lit(None).cast(own.schema["place"].dataType).alias("place")).unionAll(
        own.select("term", F.lit(False), "route", "place"))
    one = (met.join(told, "term").groupBy(key, "_risk", "route").agg(F.count("*").alias("n"), F.min("place").alias("place"))
           .groupBy(key).agg(
               F.sum(F.when(F.col("_risk"), F.col("n")).otherwise(0)).cast("int").alias("risk_hits"),
               F.array_sort(F.collect_list(F.when(~F.col("_risk"), F.struct("place", "route")))).alias("_routes")))
    one = one.withColumn("_routes", F.when(F.size("_routes") > 0, F.col("_routes")))
    out = df.join(one, key, "left").withColumn("risk_hits", F.coalesce("risk_hits", F.lit(0)))
    return out.withColumns({
        "risk_level": news.risk_level(F.col("risk_hits")), "risk_score": news.risk_score(F.col("risk_hits")),
        "relevant_routes": F.coalesce(F.array_join(F.col("_routes.route"), ", "), F.lit("General")),
    }).drop("_routes")

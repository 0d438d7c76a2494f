"""Tokens, n-grams, vocabularies, weights and encodings."""

import json

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from checks import features
from checks import views as v
from riskloom import fixed_values as fixed
from riskloom.functions import normalise as n
from riskloom.operators import stages, vectorise
from riskloom.session import settled, shared_dir
from riskloom.sources import sinks

CASES = {}


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _docs(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", "text")


WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
PLAIN = r"regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]+')"


def _summary(df, tokens):
    """Per document: how many tokens, how many different ones, and a digest of their order."""
    return df.select(
        "doc_id", F.size(tokens).cast("bigint").alias("tokens"), F.size(F.array_distinct(tokens)).cast("bigint").alias("distinct_tokens"),
        F.sha2(F.array_join(tokens, "|"), 256).alias("digest"))


def _summary_sql(expression):
    return f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS tokens, CAST(len(list_distinct(t)) AS BIGINT) AS distinct_tokens, sha256(coalesce(array_to_string(t, '|'), '')) AS digest
FROM (SELECT doc_id, {expression} AS t FROM documents)"""


@case("txt_01_words", _summary_sql(WORDS))
def txt_01(spark, sf):
    return _summary(_docs(spark, sf).withColumn("t", vectorise.words(F.col("text"))), "t")


@case("txt_02_plain_words", _summary_sql(PLAIN))
def txt_02(spark, sf):
    return _summary(_docs(spark, sf).withColumn("t", vectorise.plain_words(F.col("text"))), "t")


def _grams_sql(source, high):
    parts = [f"SELECT doc_id, w[i] AS g FROM {source}, unnest(range(1, len(w) + 1)) r(i)"]
    for k in range(2, high + 1):
        joined = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
        parts.append(f"SELECT doc_id, {joined} FROM {source}, unnest(range(1, len(w) - {k - 2})) r(i)")
    return " UNION ALL ".join(parts)


@case("txt_03_word_ngrams", f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), g AS ({_grams_sql('w', 3)})
SELECT doc_id, CAST(count(*) AS BIGINT) AS grams, CAST(count(DISTINCT g) AS BIGINT) AS distinct_grams, CAST(sum(length(g)) AS BIGINT) AS chars, min(g) AS lowest, max(g) AS highest FROM g GROUP BY doc_id""")
def txt_03(spark, sf):
    # Settled, so that the filter does not make the n-grams a second time.
    rows = settled(_docs(spark, sf).withColumn("w", vectorise.words(F.col("text"))), {"g": vectorise.word_ngrams(F.col("w"), 1, 3)})
    return rows.filter(F.size("g") > 0).select(
        "doc_id", F.size("g").cast("bigint").alias("grams"), F.size(F.array_distinct("g")).cast("bigint").alias("distinct_grams"),
        F.aggregate("g", F.lit(0).cast("bigint"), lambda total, g: total + F.length(g)).alias("chars"), F.array_min("g").alias("lowest"), F.array_max("g").alias("highest"))


CHARS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, {n_} AS n, {' || '.join(f'c[i + {j}]' for j in range(n_))} AS g FROM c, unnest(range(1, len(c) - {n_ - 2})) r(i)" for n_ in range(3, 7))
PADDED_SQL = " UNION ALL ".join(
    f"SELECT doc_id, {n_} AS n, substr(w, i, {n_}) AS g FROM p, unnest(range(1, greatest(length(w) - {n_ - 2}, 1))) r(i) WHERE length(w) > {n_}"
    for n_ in range(3, 6))


@case("txt_04_char_ngrams", rf"""WITH s AS (SELECT doc_id, regexp_replace(lower(text), '[\s\x{{a0}}\x{{85}}\x{{2028}}]{{2,}}', ' ', 'g') AS t FROM documents),
c AS (SELECT doc_id, regexp_extract_all(t, '(?s).') AS c FROM s), raw AS ({CHARS_SQL}),
p AS (SELECT doc_id, ' ' || unnest(regexp_extract_all(lower(text), '[^\s]+')) || ' ' AS w FROM documents),
inner_grams AS ({PADDED_SQL} UNION ALL SELECT doc_id, CAST(length(w) AS INTEGER), w FROM p WHERE length(w) <= 5)
SELECT 'char' AS kind, n, CAST(count(*) AS BIGINT) AS grams, CAST(count(DISTINCT g) AS BIGINT) AS distinct_grams, min(g) AS lowest, max(g) AS highest FROM raw GROUP BY n
UNION ALL SELECT 'boundary', n, CAST(count(*) AS BIGINT), CAST(count(DISTINCT g) AS BIGINT), min(g), max(g) FROM inner_grams GROUP BY n""")
def txt_04(spark, sf):
    docs = _docs(spark, sf)
    parts = []
    for kind, grams in (("char", vectorise.char_ngrams("text", 3, 6)), ("boundary", vectorise.boundary_ngrams("text", 3, 5))):
        counted = vectorise.term_statistics(docs, grams)
        parts.append(counted.groupBy(F.lit(kind).alias("kind"), F.length("term").alias("n")).agg(
            F.sum("total_count").alias("grams"), F.count(F.lit(1)).alias("distinct_grams"), F.min("term").alias("lowest"), F.max("term").alias("highest")))
    return parts[0].unionByName(parts[1])


# Bucket numbers are internal; what must hold is the number of n-grams hashed and the unit length.
@case("txt_05_hashing_vectors", f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents)
SELECT doc_id, CAST(len(w) + greatest(len(w) - 1, 0) AS BIGINT) AS terms, CASE WHEN len(w) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM w""")
def txt_05(spark, sf):
    hashing = Pipeline(stages=vectorise.hashing_stages("text", "hashed"))
    rows = hashing.fit(_docs(spark, sf)).transform(_docs(spark, sf))
    total = lambda c, f: F.aggregate(F.unwrap_udt(c)["values"], F.lit(0.0), f)
    return rows.select(
        "doc_id", total("hashed_tf", lambda a, x: a + x).cast("bigint").alias("terms"), F.round(F.sqrt(total("hashed", lambda a, x: a + x * x)), 6).alias("norm"))


STATS = f"""w AS (SELECT doc_id, {WORDS} AS w FROM documents), g AS ({_grams_sql('w', 2)}),
s AS (SELECT g AS term, CAST(count(*) AS BIGINT) AS total_count, CAST(count(DISTINCT doc_id) AS BIGINT) AS doc_count FROM g GROUP BY g)"""


def _grams(spark, sf, high=2):
    return _docs(spark, sf).withColumn("w", vectorise.words(F.col("text"))).select("doc_id", vectorise.word_ngrams(F.col("w"), 1, high).alias("g"))


@case("txt_06_vocabulary", f"""WITH {STATS} SELECT term, total_count, doc_count FROM s
WHERE doc_count >= 2 AND doc_count <= 0.95 * (SELECT count(*) FROM documents) ORDER BY total_count DESC, term LIMIT 3000""")
def txt_06(spark, sf):
    return vectorise.vocabulary(_docs(spark, sf), vectorise.WordTerms("text", 1, 2), 3000, min_df=2, max_df=0.95)


def _tfidf_sql(tf, features):
    return f"""WITH {STATS}, v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + doc_count)::DOUBLE) + 1 AS idf FROM s WHERE doc_count >= 2 ORDER BY total_count DESC, term LIMIT {features}),
t AS (SELECT doc_id, g AS term, CAST(count(*) AS BIGINT) AS tf FROM g GROUP BY ALL), x AS (SELECT doc_id, term, tf, {tf} * idf AS w FROM t JOIN v USING (term))
SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x"""


@case("txt_07_tfidf", _tfidf_sql("tf", 3000))
def txt_07(spark, sf):
    docs, grams = _docs(spark, sf), vectorise.WordTerms("text", 1, 2)
    model = vectorise.fit_tfidf(docs, grams, 3000, min_df=2)
    return model.long(docs, grams, "doc_id").withColumn("weight", F.round("weight", 6))


@case("txt_07_tfidf_sublinear", _tfidf_sql("(1 + ln(tf))", 5000))
def txt_07_sublinear(spark, sf):
    docs, grams = _docs(spark, sf), vectorise.WordTerms("text", 1, 2)
    model = vectorise.fit_tfidf(docs, grams, 5000, min_df=2, sublinear=True)
    return model.long(docs, grams, "doc_id").withColumn("weight", F.round("weight", 6))


@case("txt_08_one_hot", """WITH k AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS slot FROM (SELECT DISTINCT lang FROM documents WHERE lang <> 'es'))
SELECT doc_id, lang AS language, slot, CAST(CASE WHEN slot IS NULL THEN 0 ELSE 1 END AS BIGINT) AS hot FROM documents LEFT JOIN k USING (lang)""")
def txt_08(spark, sf):
    """Fitted without one language, which must then become all zeros."""
    docs = v.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"))
    model = Pipeline(stages=vectorise.category_stages(["language"])).fit(docs.filter("language <> 'es'"))
    slots = F.unwrap_udt("language_onehot")["indices"]
    return model.transform(docs).select("doc_id", "language", F.get(slots, F.lit(0)).alias("slot"), F.size(slots).cast("bigint").alias("hot"))


@case("txt_09_scaled_numbers", """WITH n AS (SELECT doc_id, length(text)::DOUBLE AS code_length, len(string_split(text, chr(10)))::DOUBLE AS code_lines FROM documents)
SELECT doc_id, round(code_length / (SELECT stddev_pop(code_length) FROM n), 6) AS code_length_scaled, round(code_lines / (SELECT stddev_pop(code_lines) FROM n), 6) AS code_lines_scaled FROM n""")
def txt_09(spark, sf):
    rows = _docs(spark, sf).select("doc_id", n.char_length(F.col("text")).alias("code_length"), n.raw_lines(F.col("text")).alias("code_lines"))
    scaled = vectorise.scaled_numbers(rows, ["code_length", "code_lines"])
    return scaled.select("doc_id", F.round("code_length_scaled", 6).alias("code_length_scaled"), F.round("code_lines_scaled", 6).alias("code_lines_scaled"))


MILLIONTHS = "CAST(sum(CAST(round(1000000 * x) AS BIGINT)) AS BIGINT)"
STRUCTURE_SQL = dict(zip(stages.STRUCTURE, (features.WORDS_SQL, features.INDENT_SQL, features.POINTER_OPS_SQL, features.CALLS_SQL, features.LOOPS_SQL, features.IFS_SQL)))
FAMILY_PAIRS = {f"sec_{name}": features.sql_total(patterns) for name, patterns in fixed.FAMILIES.items()}
SAFE_SQL = features.sql_total(fixed.SAFE_SIGNALS)
FAMILY_PAIRS |= {"sec_safe_patterns": SAFE_SQL, "sec_safety_ratio": f"({SAFE_SQL}) / ({' + '.join(FAMILY_PAIRS.values())} + 1)::DOUBLE"}


def _named_values(columns):
    """SQL of a list of (name, value) of some columns."""
    return "[" + ", ".join(f"{{'name': '{name}', 'x': CAST({sql} AS DOUBLE)}}" for name, sql in columns.items()) + "]"


@case("txt_10_assembled", f"""WITH {v.CORPUS}, w AS (SELECT doc_id, {WORDS.replace('text', 'raw_code')} AS w FROM corpus), g AS ({_grams_sql('w', 2)}),
s AS (SELECT g AS term, count(*) AS total_count, count(DISTINCT doc_id) AS doc_count FROM g GROUP BY g),
t AS (SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + doc_count)::DOUBLE) + 1 AS idf FROM s WHERE doc_count >= 2 ORDER BY total_count DESC, term LIMIT 500),
c AS (SELECT doc_id, g AS term, count(*) AS tf FROM g GROUP BY ALL), x AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM c JOIN t USING (term)),
u AS (SELECT term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM x),
f AS (SELECT {_named_values(STRUCTURE_SQL)} AS xs FROM corpus UNION ALL SELECT {_named_values(FAMILY_PAIRS)} FROM corpus),
l AS (SELECT unnest(xs) AS e FROM f)
SELECT 'tfidf__' || term AS slot, {MILLIONTHS} AS total FROM u GROUP BY 1
UNION ALL SELECT e.name, {MILLIONTHS.replace('* x', '* e.x')} FROM l GROUP BY 1""")
def txt_10(spark, sf):
    """The sum of every slot of the assembled vectors, under its name, after the fitted pipeline was saved and read back."""
    docs = v.corpus(spark, sf)
    found = vectorise.SyntacticFeatures.fit(docs, 500, min_df=2, sublinear=True, blocks=("structure", "security"))
    path = shared_dir(spark, "features")
    sinks.save_model(found.model, path)
    found = vectorise.SyntacticFeatures(sinks.load_model(path))
    names = F.from_json(F.lit(json.dumps(found.names)), "array<string>")
    # Slots that a row does not hold add nothing; each slot has a row, if there are any.
    held = found.transform(docs).select(F.unwrap_udt("features").alias("v"))
    places = F.coalesce(F.col("v.indices"), F.sequence(F.lit(0), F.size("v.values") - 1))
    entries = held.select(F.explode(F.arrays_zip(places.alias("slot"), F.col("v.values").alias("x"))).alias("e")).select("e.slot", "e.x")
    slots = entries.unionByName(docs.limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(len(found.names) - 1))).alias("slot"), F.lit(0.0).alias("x")))
    return slots.groupBy("slot").agg(F.sum(F.round(1_000_000 * F.col("x")).cast("bigint")).alias("total")).select(F.get(names, F.col("slot")).alias("slot"), "total")

"""Queries over the test tables, one for each operator, and the same in DuckDB's SQL.

`clips` is the clip table that most of them use: documents with metric columns made from events
and labels, so that nulls, NaN and sentinels all occur.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import arrays, numbers, signal, text
from .operators import consensus, metrics, quality, resume, scoring, spans, speakers
from .sources import clips as source
from .sources import sinks
from .storage import new_folder

LIMITS = quality.Thresholds(human_text=frozenset({"en", "fr"}), asr_text=frozenset({"de", "es"}))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def clips(spark: SparkSession, sf: str, texts: bool = True) -> DataFrame:
    """Documents meet events and labels by sorted merges: tables whose files are small enough for Spark to
    broadcast them by itself can have more rows than the driver's memory holds. What follows from a document
    alone is computed before, so that the merges sort no text for a query that needs only such figures. Without
    texts, a text that isn't blank is told by its first character that isn't white space, a blank one by none."""
    d, e, l = (table(spark, sf, x) for x in ("documents", "events", "labels"))
    d = d.withColumn("seconds", F.col("n_chars") / 150.0).select(
        "doc_id", F.concat(F.coalesce("source", F.lit("")), F.lit("/doc_"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("id"), F.col("lang").alias("dataset"),
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("source")).alias("speaker_id"), F.when(F.col("doc_id") % 11 == 0, "  ").otherwise(F.col("text")).alias("text"),
        F.col("seconds").alias("duration"), numbers.ieee_divide(numbers.ieee_divide(F.length(F.replace("text", F.lit(" "), F.lit(""))), F.col("seconds")), 4 + F.col("doc_id") % 30).alias("speaking_rate"),
    )
    d = d if texts else d.withColumn("text", F.regexp_extract("text", r"(?U)\S", 0))
    rows = d.join(e.select("event_id", "value").hint("merge"), d["doc_id"] == e["event_id"], "left").join(l.hint("merge"), "doc_id", "left")
    pick = lambda c, one, zero, none: F.when(c == 1, one).when(c == 0, zero).otherwise(none)
    return rows.select(
        *d.columns, (1 + (F.col("value") * 7 % 400) / 100).alias("distillmos"), (F.col("value") * 3 % 60).alias("wada_snr"),
        pick(F.col("quality"), 0.9, 0.7, -1.0).alias("pyt_stoi"), pick(F.col("toxic"), float("nan"), 0.1, 0.2).alias("whisper_cer"),
        (4000.0 + F.col("doc_id") * 37 % 5000).alias("bandwidth_hz"), (F.col("doc_id") % 11 / 10.0).alias("asr_agreement"), (F.col("doc_id") % 5 / 4.0).alias("speaker_conf"),
    )


CLIPS = """clips AS (SELECT doc_id, concat(source, '/doc_', doc_id) AS id, lang AS dataset, CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END AS speaker_id,
  CASE WHEN doc_id % 11 = 0 THEN '  ' ELSE text END AS text, n_chars / 150.0::DOUBLE AS duration,
  length(replace(text, ' ', '')) / (n_chars / 150.0::DOUBLE) / (4 + doc_id % 30) AS speaking_rate, 1 + (value * 7 % 400) / 100 AS distillmos, value * 3 % 60 AS wada_snr,
  CASE quality WHEN 1 THEN 0.9::DOUBLE WHEN 0 THEN 0.7::DOUBLE ELSE -1.0::DOUBLE END AS pyt_stoi, CASE toxic WHEN 1 THEN 'NaN'::DOUBLE WHEN 0 THEN 0.1::DOUBLE ELSE 0.2::DOUBLE END AS whisper_cer,
  4000.0::DOUBLE + doc_id * 37 % 5000 AS bandwidth_hz, doc_id % 11 / 10.0::DOUBLE AS asr_agreement, doc_id % 5 / 4.0::DOUBLE AS speaker_conf
  FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id LEFT JOIN labels l USING (doc_id))"""
REASONS = """marked AS (SELECT *, list_filter([
  CASE WHEN NOT isnan(distillmos) AND distillmos < 3.0 THEN 'mos' END, CASE WHEN NOT isnan(wada_snr) AND wada_snr < 15.0 THEN 'snr' END,
  CASE WHEN NOT isnan(pyt_stoi) AND pyt_stoi < 0.85 THEN 'stoi' END, CASE WHEN duration IS NOT NULL AND NOT (duration BETWEEN 1.0 AND 20.0) THEN 'dur' END,
  CASE WHEN bandwidth_hz < 6000 THEN 'bandwidth' END, CASE WHEN speaking_rate IS NOT NULL AND NOT (speaking_rate BETWEEN 5.0 AND 30.0) THEN 'srate' END,
  CASE WHEN dataset IN ('en', 'fr') AND NOT isnan(whisper_cer) AND whisper_cer > 0.15 THEN 'cer' END, CASE WHEN dataset IN ('de', 'es') AND asr_agreement < 0.6 THEN 'asr_agree' END,
  CASE WHEN coalesce(speaker_id, '') = '' AND NOT coalesce(speaker_conf >= 0.75, false) THEN 'no_speaker' END, CASE WHEN trim(coalesce(text, '')) = '' THEN 'no_text' END
  ], lambda x: x IS NOT NULL) AS reasons FROM clips)"""
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def norm_sql(x: str) -> str:
    bare = rf"regexp_replace(lower({x}), '\(.*?\)|<.*?>', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({bare}, '[!-/:-@\[-`{{-~«»—…“”„]', ' ', 'g'), '{SPACE}', ' ', 'g'))"


#: DuckDB's levenshtein counts bytes: normalized texts have no capitals, so letters beyond ASCII can
#: borrow theirs one to one.
BORROW = "translate({}, 'ßàâäçèéêëìíîïñòóôöùúûüœæÿ', 'ABCDEFGHIJKLMNOPQRSTUVWXY')"


def lev_sql(a: str, b: str) -> str:
    return f"levenshtein({BORROW.format(a)}, {BORROW.format(b)})"


def dist_sql(a: str, b: str) -> str:
    edits = f"{lev_sql(a, b)}::DOUBLE"
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 0.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, ({edits} / length({a}) + {edits} / length({b})) / 2) END"


# sources and projections


@query(f"WITH {CLIPS} SELECT * EXCLUDE (whisper_cer), isnan(whisper_cer) AS cer_failed FROM clips")
def clip_view(spark, sf):
    return clips(spark, sf).withColumn("cer_failed", F.isnan("whisper_cer")).drop("whisper_cer")


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int, TRY_CAST(json_extract_string(props, '$.k') || '.5' AS DOUBLE) AS k_double,
TRY_CAST(json_extract_string(props, '$.k') || 'x' AS INTEGER) AS k_bad FROM events""")
def numeric_cast_adapter(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select("event_id", k.try_cast("int").alias("k_int"), numbers.parse_number(F.concat(k, F.lit(".5"))).alias("k_double"), F.concat(k, F.lit("x")).try_cast("int").alias("k_bad"))


@query("SELECT doc_id, CAST((row_number() OVER (PARTITION BY doc_id % 5 ORDER BY doc_id) - 1) % 8 AS INTEGER) AS shard FROM documents")
def row_shard(spark, sf):
    """Five files of clips without ids, sharded by row number within the file."""
    from .plans.job import row_shard as shard

    path = new_folder(spark, "rows")
    d = table(spark, sf, "documents").select((F.col("doc_id") % 5).alias("part"), F.col("doc_id").cast("string").alias("audio_file"))
    d.repartition(5, "part").sortWithinPartitions("part", F.col("audio_file").cast("long")).write.partitionBy("part").options(**sinks.CSV_OUT).csv(path)
    read = source.read_csv(spark, path, one_header=True).withColumn("row", F.substring_index("id", "/", -1).cast("int"))
    parts = [shard(read, "row", r, 8).withColumn("shard", F.lit(r)) for r in range(8)]
    return reduce(DataFrame.unionByName, parts).select(F.col("audio_file").cast("long").alias("doc_id"), "shard")


@query(f"WITH {CLIPS} SELECT id, CASE WHEN trim(text) = '' THEN 'heard ' || id ELSE text END AS text, CASE WHEN trim(text) = '' THEN 'asr' END AS origin FROM clips")
def only_missing_fill(spark, sf):
    fill = lambda df: df.withColumns({"text": F.concat(F.lit("heard "), "id"), "origin": F.lit("asr")})
    return resume.fill_missing_text(clips(spark, sf).select("id", "text"), fill).select("id", "text", "origin")


@query("SELECT doc_id AS id, text, lang AS dataset FROM documents")
def csv_round_trip(spark, sf):
    path = new_folder(spark, "csv")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("clips/"), "doc_id", F.lit(".wav")).alias("audio_file"), "text", F.col("lang").alias("dataset"))
    sinks.write_csv(d, path, declared=["late"], options=sinks.EMPTY_QUOTED)
    return source.read_csv(spark, path, options=source.EMPTY_KEPT, missing_text=None).select(F.col("id").cast("long").alias("id"), "text", "dataset")


@query("SELECT doc_id AS id, text, n_chars / 150.0::DOUBLE AS duration FROM documents")
def jsonl_round_trip(spark, sf):
    path = new_folder(spark, "jsonl")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("clips/"), "doc_id", F.lit(".wav")).alias("audio_file"), "text", (F.col("n_chars") / 150.0).alias("duration"))
    sinks.write_jsonl(d, path)
    return source.read_jsonl(spark, path, "id string, audio_file string, text string, duration double").select(F.col("id").cast("long").alias("id"), "text", "duration")


@query("""WITH a AS (SELECT max_by(url, url) AS audio_file, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM pages GROUP BY 2)
SELECT doc_id, audio_file, stem FROM a JOIN documents ON CAST(doc_id AS VARCHAR) = stem""")
def sidecar_join(spark, sf):
    audio = table(spark, sf, "pages").select(F.col("url").alias("path"))
    texts = table(spark, sf, "documents").select(F.concat(F.lit("texts/"), "doc_id", F.lit(".txt")).alias("text_file"), "doc_id")
    return source.beside(audio, texts).select("doc_id", F.col("path").alias("audio_file"), F.col("_stem").alias("stem"))


@query("SELECT source AS dataset, row_number() OVER (ORDER BY SUM(octet_length(encode(text))), source)::INTEGER AS place FROM documents WHERE source IS NOT NULL AND text IS NOT NULL GROUP BY source")
def dataset_order(spark, sf):
    """A data set for each source, as large as its texts."""
    path = new_folder(spark, "sets")
    d = table(spark, sf, "documents").where("source IS NOT NULL AND text IS NOT NULL")
    d.select("source", F.base64(F.encode("text", "UTF-8")).alias("text")).repartition(1, "source").write.partitionBy("source").text(path)
    found = source.datasets(spark, path, ".txt").select(F.regexp_replace("dataset", "^source=", "").alias("dataset"), "length")
    return found.withColumn("place", F.row_number().over(Window.orderBy("length", "dataset"))).select("dataset", "place")  # a row a data set


# text


@query(f"SELECT 'benchmark' AS kind, item_id AS id, {norm_sql('text')} AS norm FROM benchmark UNION ALL SELECT 'page', page_id, {norm_sql('html')} FROM pages")
def normalize_text(spark, sf):
    b = table(spark, sf, "benchmark").select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"), text.normalize_text(F.col("text")).alias("norm"))
    return b.union(table(spark, sf, "pages").select(F.lit("page"), "page_id", text.normalize_text(F.col("html"))))


@query(rf"""WITH t AS (SELECT item_id, list_filter(string_split_regex(text, '{SPACE}'), lambda x: x <> '') AS toks FROM benchmark),
w AS (SELECT item_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS place FROM t)
SELECT item_id, place::INTEGER AS place, regexp_extract(tok, '^(.*?)([.,!?]*)$', 1) AS word, right(regexp_extract(tok, '^(.*?)([.,!?]*)$', 2), 1) AS mark
FROM w WHERE regexp_extract(tok, '^(.*?)([.,!?]*)$', 1) <> ''""")
def trailing_punct_split(spark, sf):
    parts = text.split_trailing_punct(F.col("text"))
    return table(spark, sf, "benchmark").select("item_id", F.posexplode(parts).alias("p", "w")).select("item_id", (F.col("p") + 1).alias("place"), "w.word", "w.mark")


def turn_pairs(spark, sf) -> DataFrame:
    by = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("ref"), F.lead("text").over(by).alias("hyp")).where("hyp IS NOT NULL")


TURNS = f"turns AS (SELECT conv_id, turn, {norm_sql('text')} AS a, lead({norm_sql('text')}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations)"


@query()
def punctuation_transfer(spark, sf):
    moved = text.transfer_punctuation()("ref", "hyp")
    return turn_pairs(spark, sf).withColumn("m", moved).select("conv_id", "turn", "m.text", "m.share")


@query(r"""WITH t AS (SELECT doc_id, n_chars / 150.0::DOUBLE AS duration, trim(text, E' \t\n\r\f\v') AS s FROM documents),
w AS (SELECT *, len(regexp_extract_all(s, '[\p{L}\p{M}\p{Nd}\p{Pc}]+')) AS words, length(replace(s, ' ', '')) AS units FROM t)
SELECT doc_id, CASE WHEN s = '' OR duration <= 0 THEN 0 ELSE units / duration END AS speaking_rate, CASE WHEN s = '' OR duration <= 0 OR words = 0 THEN 0 ELSE units / words END AS phonemes_per_word,
CASE WHEN duration > 0 THEN length(s) / duration ELSE 0 END AS char_rate FROM w""")
def speaking_rate(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", (F.col("n_chars") / 150.0).alias("duration"))
    return metrics.speaking_rate(d).drop("text", "duration")


@query(f"WITH {TURNS} SELECT conv_id, turn, CASE WHEN a = '' THEN -1.0::DOUBLE ELSE {lev_sql('a', 'b')} / length(a)::DOUBLE END AS cer FROM turns WHERE b IS NOT NULL")
def cer_pairs(spark, sf):
    return text.with_error_rates(turn_pairs(spark, sf), F.col("ref"), F.col("hyp"), None, "cer").select("conv_id", "turn", "cer")


#: The table of the edit distance by words, a row for each word of r, each from the row before.
WORD_EDITS = """list_reduce(list_transform(r, lambda w: [list_position(v, w)::INTEGER]), lambda o, w: list_reduce(list_transform(range(1, len(h) + 1), lambda j: [least(o[j + 1] + 1, o[j] + (w[1] <> x[j])::INTEGER)]),
lambda n, t: list_append(n, least(n[-1] + 1, t[1])), [o[1] + 1]), list_transform(range(0, len(h) + 1), lambda j: j::INTEGER))[-1]"""


@query(f"""WITH {TURNS}, s AS (SELECT conv_id, turn, list_filter(string_split(a, ' '), lambda w: w <> '') AS r, list_filter(string_split(b, ' '), lambda w: w <> '') AS h FROM turns WHERE b IS NOT NULL),
d AS (SELECT *, list_distinct(list_concat(r, h)) AS v FROM s), e AS (SELECT *, list_transform(h, lambda w: list_position(v, w)::INTEGER) AS x FROM d)
SELECT conv_id, turn, CASE WHEN len(r) = 0 THEN -1.0::DOUBLE ELSE {WORD_EDITS}::DOUBLE / len(r) END AS wer FROM e""")
def wer_pairs(spark, sf):
    return text.with_error_rates(turn_pairs(spark, sf), F.col("ref"), F.col("hyp"), "wer", None).select("conv_id", "turn", "wer")


@query(f"WITH {TURNS} SELECT conv_id, turn, {dist_sql('a', 'b')} AS distance FROM turns WHERE b IS NOT NULL")
def pair_distances(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", text.pair_distance(text.normalize_text(F.col("ref")), text.normalize_text(F.col("hyp"))).alias("distance"))


# consensus: the first three turns of a conversation stand for three recognizers


def candidates(spark, sf) -> DataFrame:
    t = lambda k: F.max(F.when(F.col("turn") == k, F.col("text")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(*[F.coalesce(t(k), F.lit("")).alias(f"text_{x}") for k, x in enumerate("abc")])
    return rows.withColumns({f"status_{x}": F.when(F.col(f"text_{x}") == "", "no_speech").otherwise("ok") for x in "abc"})


_N = {x: norm_sql(f"text_{x}") for x in "abc"}
_MEAN = "CASE n WHEN 0 THEN NULL WHEN 1 THEN 0.0::DOUBLE ELSE ({}) / (n - 1) END"
CANDIDATES = f"""c AS (SELECT conv_id, {', '.join(f"coalesce(max(CASE WHEN turn = {k} THEN text END), '') AS text_{x}" for k, x in enumerate("abc"))} FROM conversations GROUP BY conv_id),
m AS (SELECT *, {', '.join(f"{v} AS n_{k}, text_{k} <> '' AS ok_{k}, regexp_matches(text_{k}, '[.,!?…;:—]') AND text_{k} <> '' AS p_{k}" for k, v in _N.items())}, (text_a <> '')::INT + (text_b <> '')::INT + (text_c <> '')::INT AS n FROM c),
d AS (SELECT *, {', '.join(f"CASE WHEN ok_{x} AND ok_{y} THEN {dist_sql(f'n_{x}', f'n_{y}')} ELSE 0.0::DOUBLE END AS d_{x}{y}" for x, y in ('ab', 'ac', 'bc'))} FROM m),
s AS (SELECT *, CASE WHEN ok_a THEN {_MEAN.format('d_ab + d_ac')} END AS m_a, CASE WHEN ok_b THEN {_MEAN.format('d_ab + d_bc')} END AS m_b, CASE WHEN ok_c THEN {_MEAN.format('d_ac + d_bc')} END AS m_c FROM d),
b AS (SELECT *, least(m_a, m_b, m_c) AS best, least(CASE WHEN p_a THEN m_a END, CASE WHEN p_b THEN m_b END, CASE WHEN p_c THEN m_c END) AS best_p FROM s),
e AS (SELECT *, CASE WHEN m_a = best THEN 'a' WHEN m_b = best THEN 'b' WHEN m_c = best THEN 'c' ELSE '' END AS medoid,
  CASE WHEN p_a AND m_a = best_p THEN 'a' WHEN p_b AND m_b = best_p THEN 'b' WHEN p_c AND m_c = best_p THEN 'c' END AS marked FROM b),
f AS (SELECT *, CASE WHEN marked IS NULL OR (medoid = 'a' AND p_a) OR (medoid = 'b' AND p_b) OR (medoid = 'c' AND p_c) THEN medoid ELSE marked END AS selected FROM e)"""
CHOSEN = "CASE selected WHEN 'a' THEN text_a WHEN 'b' THEN text_b WHEN 'c' THEN text_c ELSE '' END"


def reduced(spark, sf) -> DataFrame:
    return consensus.consensus_columns(candidates(spark, sf), [(x, f"status_{x}", f"text_{x}") for x in "abc"])


@query(f"WITH {CANDIDATES} SELECT conv_id, medoid, CASE WHEN n >= 2 THEN bround(greatest(0.0::DOUBLE, 1 - best), 9) END AS agreement FROM f".replace("bround(", "round_even("))
def consensus_medoid(spark, sf):
    return reduced(spark, sf).select("conv_id", F.col("consensus_medoid").alias("medoid"), F.bround("consensus_agreement", 9).alias("agreement"))


@query(f"WITH {CANDIDATES} SELECT conv_id, selected, {CHOSEN} AS text, selected <> medoid AS changed FROM f")
def consensus_punctuated(spark, sf):
    return reduced(spark, sf).select("conv_id", F.col("consensus_selected").alias("selected"), F.col("consensus_text").alias("text"), F.col("consensus_changed").alias("changed"))


@query(f"""WITH {CANDIDATES} SELECT conv_id, CASE n WHEN 0 THEN 'no_candidate' WHEN 1 THEN 'single_candidate' ELSE 'ok' END AS status,
'[' || array_to_string(list_filter([CASE WHEN ok_a THEN '"a"' END, CASE WHEN ok_b THEN '"b"' END, CASE WHEN ok_c THEN '"c"' END], lambda x: x IS NOT NULL), ',') || ']' AS eligible FROM f""")
def consensus_status(spark, sf):
    return reduced(spark, sf).select("conv_id", F.col("consensus_status").alias("status"), F.col("consensus_eligible").alias("eligible"))


@query(f"""WITH {CANDIDATES}, g AS (SELECT *, CASE WHEN n = 0 THEN 0.0::DOUBLE WHEN n = 1 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1 - best) END AS agreed FROM f)
SELECT conv_id, selected AS asr_chosen_backend, round_even(agreed, 4) AS asr_agreement, agreed < 0.3 AS asr_low_confidence, {CHOSEN} AS text FROM g""")
def low_confidence_flag(spark, sf):
    rows = candidates(spark, sf).withColumn("text", F.lit(""))
    found = consensus.transcript_columns(rows, {x: F.col(f"text_{x}") for x in "abc"}, min_agreement=0.3)
    return found.select("conv_id", "asr_chosen_backend", "asr_agreement", "asr_low_confidence", "text")


# merging and resuming


@query("""WITH s AS (SELECT 0 AS shard, doc_id, text FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT 1, doc_id, '2:' || text FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 2, doc_id, '3:' || text FROM documents),
k AS (SELECT *, CASE WHEN doc_id % 13 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS id FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY shard) AS n FROM k)
SELECT id, doc_id, text FROM r WHERE n = 1 OR id = ''""")
def merge_first_wins(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    keyed = lambda x: x.withColumn("id", F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.col("doc_id").cast("string")))
    shards = [d.where("doc_id % 3 <> 0"), d.where("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("2:"), "text")), d.withColumn("text", F.concat(F.lit("3:"), "text"))]
    return resume.merge_first([keyed(s) for s in shards], "id", order="doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_todo(spark, sf):
    return resume.todo(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("SELECT d.doc_id, d.lang, coalesce(quality, -9) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def resume_restore(spark, sf):
    run = lambda rest: rest.withColumn("quality", F.lit(-9))
    return resume.resume(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), run, ["quality"], "doc_id")


@query("""SELECT doc_id, sha256(text) AS content_hash, sha256('{"sha":"' || sha256(text) || '","in0":"' || lang || '"}') AS fingerprint FROM documents""")
def input_fingerprint(spark, sf):
    content = F.encode("text", "UTF-8")
    return table(spark, sf, "documents").select("doc_id", arrays.input_fingerprint(content).alias("content_hash"), arrays.input_fingerprint(content, F.col("lang")).alias("fingerprint"))


@query("""WITH e AS (SELECT user_id, event_id, value > 60 AS failed FROM events), g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - sum(failed::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e),
r AS (SELECT user_id, island, count_if(failed) AS n FROM g GROUP BY ALL) SELECT user_id, sum(n)::BIGINT AS failures, max(n)::BIGINT AS longest_streak FROM r GROUP BY user_id""")
def failure_streak(spark, sf):
    return spans.failure_streaks(table(spark, sf, "events"), "user_id", "event_id", F.col("value") > 60)


@query(r"""WITH c AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' and more' ELSE text END AS text, n_chars / 150.0::DOUBLE AS duration FROM documents),
t AS (SELECT *, trim(text, E' \t\n\r\f\v') AS s FROM c)
SELECT doc_id, CASE WHEN s = '' OR duration <= 0 THEN 0 ELSE length(replace(s, ' ', '')) / duration END AS speaking_rate, CASE WHEN duration > 0 THEN length(s) / duration ELSE 0 END AS char_rate FROM t""")
def job_resume(spark, sf):
    """A job over two thirds of the documents, then over all of them, of which a fifth has changed: what the first run
    did and still holds comes from its checkpoint."""
    from .plans import job as jobs

    folder = new_folder(spark, "job")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("clips/"), "doc_id", F.lit(".wav")).alias("audio_file"), "text", (F.col("n_chars") / 150.0).alias("duration"))
    changed = d.withColumn("text", F.when(F.col("id").cast("long") % 5 == 0, F.concat("text", F.lit(" and more"))).otherwise(F.col("text")))
    for k, rows in enumerate((d.where("id % 3 <> 0"), changed)):
        rows.write.parquet(f"{folder}/in_{k}")
        jobs.run_job(spark, jobs.Job({"type": "parquet", "path": f"{folder}/in_{k}"}, {"type": "parquet", "path": f"{folder}/out_{k}"}, [{"step": "speaking_rate"}], "resume", f"{folder}/kept", fingerprint=["text"]))
    return spark.read.parquet(f"{folder}/out_1").select(F.col("id").cast("long").alias("doc_id"), "speaking_rate", "char_rate")


# quality


@query(f"WITH {CLIPS}, {REASONS}, x AS (SELECT unnest(reasons) AS reason FROM marked) SELECT reason, count(*)::BIGINT AS clips, round_even(100 * count(*) / (SELECT count(*) FROM marked)::DOUBLE, 6) AS percent FROM x GROUP BY reason")
def drop_reasons(spark, sf):
    return quality.reason_counts(clips(spark, sf, texts=False), LIMITS).withColumn("percent", F.bround("percent", 6))


@query(f"WITH {CLIPS}, {REASONS} SELECT id, array_to_string(reasons, ' ') AS reasons FROM marked")
def clip_reasons(spark, sf):
    return quality.with_reasons(clips(spark, sf), LIMITS).select("id", F.array_join("reasons", " ").alias("reasons"))


@query(f"WITH {CLIPS}, {REASONS} SELECT id, dataset, duration, text FROM marked WHERE len(reasons) = 0")
def clean_rows(spark, sf):
    return quality.clean(clips(spark, sf), LIMITS).select("id", "dataset", "duration", "text")


@query(f"""WITH {CLIPS}, {REASONS} SELECT count(*)::BIGINT AS clips, round_even(sum(duration) / 3600, 6) AS hours, count(DISTINCT nullif(trim(speaker_id), ''))::BIGINT AS speakers,
count_if(len(reasons) = 0)::BIGINT AS kept, (100 * count_if(len(reasons) = 0) // greatest(1, count(*)))::BIGINT AS kept_percent FROM marked""")
def qa_summary(spark, sf):
    return quality.summary(clips(spark, sf), LIMITS).withColumn("hours", F.bround("hours", 6))


def _share_sql() -> str:
    rows = []
    for m, _, kind, limit in quality.metric_limits(LIMITS, human=True, asr=True):
        v = f"CASE WHEN {m} IS NULL OR isnan({m}) OR {m} < 0 THEN NULL ELSE {m} END"
        ok = f"v >= {limit}" if kind == "ge" else f"v <= {limit}" if kind == "le" else f"v BETWEEN {limit[0]} AND {limit[1]}"
        rows.append(f"SELECT '{m}' AS metric, count(*)::BIGINT AS clips, count_if(v IS NULL)::BIGINT AS missing, count_if(NOT ({ok}))::BIGINT AS failing FROM (SELECT {v} AS v FROM clips)")
    return f"WITH {CLIPS} " + " UNION ALL ".join(rows)


@query(_share_sql())
def fail_missing_share(spark, sf):
    return quality.fail_shares(clips(spark, sf), quality.metric_limits(LIMITS, human=True, asr=True))


QUANTILES = [0.005, 0.25, 0.5, 0.9, 0.995]
RANKED = "r AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS place, count(*) OVER () AS n FROM events WHERE value IS NOT NULL)"


@query(f"WITH {RANKED} " + " UNION ALL ".join(f"SELECT {q}::DOUBLE AS q, value FROM r WHERE place = least(n - 1, floor({q}::DOUBLE * n))" for q in QUANTILES))
def nearest_rank_quantile(spark, sf):
    return quality.nearest_rank(table(spark, sf, "events"), "value", QUANTILES)


@query(f"""WITH {RANKED}, b AS (SELECT least(min(CASE WHEN place = least(n - 1, floor(0.005::DOUBLE * n)) THEN value END), 100.0) AS lo, greatest(max(CASE WHEN place = least(n - 1, floor(0.995::DOUBLE * n)) THEN value END), 100.0) AS h FROM r),
c AS (SELECT lo, CASE WHEN h <= lo THEN lo + 1 ELSE h END AS hi FROM b)
SELECT floor((least(greatest(value, lo), hi) - lo) / (hi - lo) * 47)::INTEGER AS bin, count(*)::BIGINT AS clips FROM r, c GROUP BY 1""")
def metric_histogram(spark, sf):
    return quality.histogram(table(spark, sf, "events"), "value", 100.0)


@query("""WITH v AS (SELECT event_id, value, value >= 50.0 AS passing, abs(value - 50.0) AS distance FROM events WHERE value >= 0),
r AS (SELECT *, row_number() OVER (PARTITION BY passing ORDER BY distance, event_id) AS place FROM v) SELECT event_id, value, passing, place::INTEGER AS place FROM r WHERE place <= 20""")
def near_threshold(spark, sf):
    return quality.near_limit(table(spark, sf, "events").select("event_id", "value"), "value", "ge", 50.0, 20, "event_id").drop("distance")


@query("WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN -value WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN NULL ELSE value END AS raw FROM events) SELECT event_id, CASE WHEN isnan(raw) OR raw < 0 THEN NULL ELSE raw END AS value FROM v")
def sentinel_to_null(spark, sf):
    r = F.col("event_id") % 4
    raw = F.when(r == 0, -F.col("value")).when(r == 1, float("nan")).when(r == 2, F.lit(None).cast("double")).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", numbers.sentinel_to_null(raw).alias("value"))


@query("SELECT count(*)::BIGINT AS n, round_even(corr(l_extendedprice, l_quantity * 1000), 6) AS pearson, round_even(avg(abs(l_extendedprice - l_quantity * 1000)), 4) AS mae, round_even(max(l_extendedprice - l_quantity * 1000) - min(l_extendedprice - l_quantity * 1000), 4) AS spread FROM lineitem")
def metric_agreement(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("a"), (F.col("l_quantity") * 1000).alias("b"))
    return quality.agreement(rows, "a", "b").select("n", F.bround("pearson", 6).alias("pearson"), F.bround("mae", 4).alias("mae"), F.bround("spread", 4).alias("spread"))


@query("""WITH r AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS a, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS b FROM orders)
SELECT count(*)::BIGINT AS n, round_even(corr(a, b), 6) AS spearman FROM r""")
def rank_agreement(spark, sf):
    return quality.spearman(table(spark, sf, "orders"), "o_totalprice", "o_custkey", "o_orderkey").withColumn("spearman", F.bround("spearman", 6))


@query()
def deterministic_sample(spark, sf):
    return quality.sample(clips(spark, sf).select("id", "dataset", "duration"), "id", 20)


# vectors


@query("SELECT vec_id, round_even(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings")
def embedding_norm(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.bround(numbers.l2_norm(F.col("embedding")), 6).alias("norm"))


CENTERS = """u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v, embedding FROM embeddings),
p AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings), a AS (SELECT label, pos, avg(x) AS x FROM p GROUP BY ALL),
z AS (SELECT label, list(x ORDER BY pos) AS c FROM a GROUP BY label), c AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS c FROM z),
s AS (SELECT vec_id, u.label AS own, c.label, list_dot_product(v, c.c) AS sim FROM u, c)"""


@query(f"WITH {CENTERS} SELECT vec_id, label, round_even(sim, 6) AS similarity FROM s")
def centroid_similarity(spark, sf):
    e = table(spark, sf, "embeddings")
    return speakers.similarities(e, "vec_id", "embedding", speakers.centroids(e, "label", "embedding")).withColumn("similarity", F.bround("similarity", 6))


@query(f"""WITH {CENTERS}, t AS (SELECT vec_id, max(own) AS own, max(CASE WHEN label = own THEN sim END) AS conf, list_sort(list(sim), 'DESC') AS top FROM s GROUP BY vec_id)
SELECT vec_id, CASE WHEN conf >= 0.2 AND top[1] - top[2] >= 0.05 THEN printf('spk_%03d', own) ELSE 'unknown' END AS speaker, round_even(conf, 4) AS speaker_conf, round_even(top[1] - top[2], 4) AS speaker_margin FROM t""")
def speaker_assign(spark, sf):
    e = table(spark, sf, "embeddings")
    return speakers.assign_speakers(e, "vec_id", "embedding", "label", 0.2, 0.05).select("vec_id", "speaker", "speaker_conf", "speaker_margin")


@query()
def speaker_cluster(spark, sf):
    return speakers.cluster_speakers(table(spark, sf, "embeddings"), "vec_id", "embedding", 0.9, folder=new_folder(spark, "clusters"))


# spans


@query("""WITH b AS (SELECT user_id, event_type, sum(value) AS s FROM events GROUP BY ALL)
SELECT user_id, count(*)::BIGINT AS num_speakers, round_even(max(s) / sum(s), 4) AS top_speaker_ratio FROM b GROUP BY user_id""")
def diarization_summary(spark, sf):
    return speakers.diarization_summary(table(spark, sf, "events"), "user_id", "event_type", F.col("value"))


WORDS = "w AS (SELECT user_id, event_id, event_type AS text, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) * 0.5::DOUBLE AS s FROM events), x AS (SELECT *, s AS start, s + value / 150 AS stop FROM w)"


def event_words(spark, sf) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf, "events").select("user_id", "event_id", F.col("event_type").alias("text"), "value", ((F.row_number().over(by) - 1) * 0.5).alias("start"))
    return rows.withColumn("end", F.col("start") + F.col("value") / 150)


@query(f"WITH {WORDS} SELECT user_id, event_id, coalesce(start >= lag(stop) OVER (PARTITION BY user_id ORDER BY event_id), true) AS monotonic FROM x")
def alignment_monotonic(spark, sf):
    return spans.out_of_order(event_words(spark, sf), "user_id", "event_id", F.col("start"), F.col("end")).select("user_id", "event_id", "monotonic")


@query(f"""WITH {WORDS}, l AS (SELECT *, lag(stop) OVER (PARTITION BY user_id, event_id // 8 ORDER BY event_id) AS before FROM x),
g AS (SELECT user_id, event_id // 8 AS part, bool_and(coalesce(start >= before, true)) AS good, max_by(stop, event_id) AS stop, count(*) AS n, min(start) AS first FROM l GROUP BY ALL)
SELECT user_id, part, CASE WHEN part % 5 = 0 THEN 'empty_text' WHEN NOT good THEN 'error'
WHEN stop::VARCHAR::DECIMAL(28, 10) * 16000 <= floor(first * 16000 + n * 4000)::BIGINT + 1280 THEN 'ok' ELSE 'out_of_bounds' END AS status FROM g""")
def alignment_status(spark, sf):
    rows = event_words(spark, sf).groupBy("user_id", F.expr("event_id div 8").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "text", "start", "end"))).alias("words"), F.min("start").alias("first"), F.count(F.lit(1)).alias("n")
    )
    frames = F.floor(F.col("first") * 16000 + F.col("n") * 4000)
    spoken = F.when(F.col("part") % 5 == 0, " ").otherwise("x")
    return rows.select("user_id", "part", spans.alignment_status(spoken, F.col("words"), frames, F.lit(16000)).alias("status"))


@query("""WITH c AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id), t AS (SELECT conv_id, string_split(text, ' ') AS toks FROM c),
w AS (SELECT conv_id, generate_subscripts(toks, 1) - 1 AS p, ' ' || unnest(toks) AS word, len(toks) AS n FROM t), x AS (SELECT *, p * 0.75::DOUBLE AS s, p * 0.75::DOUBLE + 0.5 AS e, n * 0.75::DOUBLE + 1 AS f FROM w),
y AS (SELECT *, lag(e) OVER b AS before, coalesce(lead(s) OVER b, f) AS nxt, right(word, 1) IN ('.', '!', '?') AS ends FROM x WINDOW b AS (PARTITION BY conv_id ORDER BY p)),
z AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM y),
g AS (SELECT conv_id, sentence, string_agg(word, '' ORDER BY p) AS text, min_by(s, p) AS s, arg_min_null(before, p) AS before, max_by(e, p) AS e, max_by(nxt, p) AS nxt, max_by(ends, p) AS ends FROM z GROUP BY ALL)
SELECT conv_id, sentence::INTEGER AS sentence, substr(text, 2) AS text, greatest(CASE WHEN before IS NULL THEN greatest(s - 0.5, 0) ELSE greatest(s - 0.5, (before + s) / 2) END - 0.5, 0)::DOUBLE AS start_timestamp,
least((e + nxt) / 2, e + 0.5)::DOUBLE AS end_timestamp FROM g WHERE ends""")
def sentence_split(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("text"))
    words = c.select("conv_id", F.split("text", " ").alias("toks")).select("conv_id", F.size("toks").alias("n"), F.posexplode("toks").alias("p", "word"))
    words = words.select("conv_id", "p", F.concat(F.lit(" "), "word").alias("word"), (F.col("p") * 0.75).alias("start"), (F.col("p") * 0.75 + 0.5).alias("end"), (F.col("n") * 0.75 + 1).alias("f"))
    return spans.sentences(words, "conv_id", "p", F.col("f"))


@query("""WITH t AS (SELECT user_id, event_type AS speaker, event_id / 10.0::DOUBLE AS s, (event_id + value) / 10.0::DOUBLE AS e, value FROM events),
g AS (SELECT user_id, list({'speaker': speaker, 'start': round_even(s, 3)::DOUBLE, 'end': round_even(e, 3)::DOUBLE} ORDER BY speaker, s, e) AS turns, count(DISTINCT speaker) AS n, count(*) AS k,
  bool_and(coalesce(speaker, '') <> '' AND isfinite(s) AND isfinite(e) AND s >= 0 AND s < e) AS good, sum(value) AS total FROM t GROUP BY user_id),
m AS (SELECT *, user_id % 3 = 0 AS bare, (CASE WHEN user_id % 3 = 0 THEN 0 ELSE n END) + (CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END) AS told, CASE WHEN user_id % 3 = 0 THEN 0 ELSE n END AS heard FROM g),
r AS (SELECT *, CASE WHEN user_id % 7 = 0 THEN 'no_speech' WHEN NOT good OR told <> heard OR k = 0 OR NOT isfinite(total) THEN 'error' WHEN bare THEN 'raw_only' ELSE 'ok' END AS status FROM m)
SELECT user_id, status AS senko_status, CASE WHEN status IN ('ok', 'raw_only') THEN told ELSE 0 END::INTEGER AS senko_num_speakers,
CASE WHEN status = 'ok' THEN k ELSE 0 END::INTEGER AS n_segments, CASE WHEN status IN ('ok', 'raw_only') THEN k ELSE 0 END::INTEGER AS n_raw,
CASE WHEN status IN ('ok', 'raw_only') THEN round_even(list_sum(list_transform(turns, lambda x: x['end'] - x['start'])), 3) ELSE 0 END::DOUBLE AS raw_seconds,
CASE WHEN status IN ('ok', 'raw_only') THEN turns[1]['speaker'] END AS first_speaker FROM r""")
def diarization_columns(spark, sf):
    turn = F.struct(F.col("event_type").alias("speaker"), (F.col("event_id") / 10).alias("start"), ((F.col("event_id") + F.col("value")) / 10).alias("end"))
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(turn)).alias("raw"), F.sum("value").alias("total"))
    rows = rows.withColumns({"merged": F.when(F.col("user_id") % 3 == 0, F.slice("raw", 1, 0)).otherwise(F.col("raw")), "timing": F.create_map(F.lit("total"), "total")})
    rows = rows.withColumn("n", F.size(F.array_distinct(F.transform("merged", lambda x: x["speaker"]))) + F.when(F.col("user_id") % 5 == 0, 1).otherwise(0))
    out = spans.diarization_columns(rows, "merged", "raw", "n", "timing", F.col("user_id") % 7 == 0)
    parsed = lambda x: F.from_json(x, "array<struct<speaker string, start double, end double>>")
    out = out.withColumns({"raw": parsed("senko_raw_segments"), "merged": parsed("senko_segments")})
    seconds = F.aggregate("raw", F.lit(0.0), lambda a, x: a + (x["end"] - x["start"]))
    return out.select(
        "user_id", "senko_status", F.col("senko_num_speakers").cast("int").alias("senko_num_speakers"), F.size("merged").alias("n_segments"), F.size("raw").alias("n_raw"),
        F.bround(seconds, 3).alias("raw_seconds"), F.get(F.col("raw"), F.lit(0))["speaker"].alias("first_speaker"),
    )


# signals: embeddings stand in for samples


@query(f"""WITH g AS (SELECT [{', '.join(f'{x}::DOUBLE' for x in numbers.WADA_CURVE)}] AS curve),
l AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x)::DOUBLE) AS m FROM embeddings), s AS (SELECT vec_id, list_transform(m, lambda x: greatest(x / list_max(m), 1e-10::DOUBLE)) AS z FROM l),
v AS (SELECT vec_id, ln(list_avg(z)) - list_avg(list_transform(z, lambda x: ln(x))) AS v FROM s), i AS (SELECT vec_id, v, curve, len(list_filter(curve, lambda x: x < v)) AS k, list_max(list_transform(range(1, 122), lambda j: CASE WHEN curve[j] < v THEN j ELSE 0 END)) AS j FROM v, g)
SELECT vec_id, round_even(CASE WHEN j = 0 THEN -20 WHEN j = 121 THEN 100 ELSE -21 + j + (v - curve[j]) / (curve[j + 1] - curve[j]) END, 6)::DOUBLE AS wada_snr FROM i""")
def wada_snr_array(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.bround(numbers.wada_snr(F.col("embedding")), 6).alias("wada_snr"))


@query("""WITH f AS (SELECT vec_id, i, list_sum(list_transform(embedding[greatest(i * 8 - 16, 0) + 1 : least(i * 8 + 16, 64)], lambda x: x::DOUBLE * x::DOUBLE)) / 32 AS p FROM embeddings, range(0, 9) r(i)),
d AS (SELECT vec_id, 20 * log10(greatest(sqrt(coalesce(p, 0)), 1e-8)) AS db FROM f) SELECT vec_id, round_even(avg(db), 6) AS energy_db, round_even(stddev_pop(db), 6) AS energy_dynamics FROM d GROUP BY vec_id""")
def rms_energy(spark, sf):
    level = F.transform(arrays.rms_frames(F.col("embedding"), 32, 8), numbers.level_db)
    rows = table(spark, sf, "embeddings").select("vec_id", level.alias("l"))
    return rows.select("vec_id", F.bround(arrays.array_mean(F.col("l")), 6).alias("energy_db"), F.bround(arrays.array_std(F.col("l")), 6).alias("energy_dynamics"))


@query("SELECT vec_id, r.i::INTEGER AS place, round_even(list_avg(list_transform(embedding[r.i * 10 + 1 : least(r.i * 10 + 10, 64)], lambda x: x::DOUBLE)), 6) AS mean FROM embeddings, range(0, 7) r(i)")
def window_means(spark, sf):
    means = arrays.window_means(F.col("embedding"), 10, 1.0)
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(means).alias("place", "mean")).withColumn("mean", F.bround("mean", 6))


@query("""WITH l AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: x::DOUBLE) AS z FROM embeddings), s AS (SELECT *, list_sum(list_transform(z, lambda x: exp(x - list_max(z)))) AS t FROM l)
SELECT vec_id, ['neutral', 'angry', 'positive', 'sad'][list_position(z, list_max(z))] AS emotion_pred, round_even(1 / t, 6) AS emotion_score FROM s""")
def label_score_map(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double")).alias("logits"))
    out = metrics.labelled(rows, "logits", ["neutral", "angry", "positive", "sad"], "label_score", ["emotion_pred", "emotion_score"])
    return out.select("vec_id", "emotion_pred", F.bround("emotion_score", 6).alias("emotion_score"))


@query("SELECT user_id, round_even(CASE WHEN avg(value) > 0 THEN stddev_pop(value) / avg(value) ELSE 0 END, 6)::DOUBLE AS expressiveness FROM events GROUP BY user_id")
def expressiveness(spark, sf):
    by = table(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return by.select("user_id", F.bround(numbers.expressiveness(F.col("m"), F.col("s")), 6).alias("expressiveness"))


@query()
def signal_measures(spark, sf):
    """Half a second of tone for each vector, its pitch by the label, measured from WAV bytes."""

    @F.pandas_udf("binary")
    def tone(label: pd.Series) -> pd.Series:
        import numpy as np

        t = np.arange(8000) / 16000
        return pd.Series([signal.encode_wav(0.5 * np.sin(2 * np.pi * (110 + 20 * k) * t), 16000) for k in label])

    rows = table(spark, sf, "embeddings").select("vec_id", "label", tone("label").alias("content"))
    return metrics.signal_metrics(rows, ["bandwidth", "wada_snr", "pitch", "style"]).drop("content")


# scoring


class _Toy(scoring.Scorer):
    """Counts words; fails on every document whose id ends in 7, for want of memory on those in 3."""

    inputs = ("doc_id", "text")
    outputs = {"n_words": "double"}

    def score(self, model, clip):
        if clip["doc_id"] % 10 == 7:
            raise RuntimeError("broken")
        if clip["doc_id"] % 10 == 3:
            raise MemoryError("out of memory")
        return float(len(clip["text"].split()))

    def recover(self, model, clip):
        return float(len(clip["text"].split()))


@query(rf"""SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN -1 ELSE len(list_filter(string_split_regex(text, '{SPACE}'), lambda x: x <> '')) END::BIGINT AS n_words,
CASE WHEN doc_id % 10 = 7 THEN 'inference_error' END AS error FROM documents""")
def scorer_guard(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", (F.col("n_chars") / 150.0).alias("duration"))
    found = scoring.run_scorer(d, _Toy(), "error")
    return found.select("doc_id", F.when(F.isnan("n_words"), -1).otherwise(F.col("n_words")).cast("long").alias("n_words"), "error")


@query("""WITH RECURSIVE d AS (SELECT doc_id, lang, n_chars / 150.0::DOUBLE AS s, row_number() OVER (PARTITION BY lang ORDER BY n_chars / 150.0::DOUBLE, doc_id) AS n FROM documents),
b AS (SELECT doc_id, lang, n, 0 AS batch, 1 AS size FROM d WHERE n = 1 UNION ALL
SELECT d.doc_id, d.lang, d.n, CASE WHEN size < 16 AND (size + 1) * s <= 480 THEN batch ELSE batch + 1 END, CASE WHEN size < 16 AND (size + 1) * s <= 480 THEN size + 1 ELSE 1 END
FROM b JOIN d ON d.lang IS NOT DISTINCT FROM b.lang AND d.n = b.n + 1) SELECT doc_id, lang, batch::INTEGER AS batch FROM b""")
def length_buckets(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", (F.col("n_chars") / 150.0).alias("duration"))
    return scoring.batches_of(d, "doc_id", "duration", 480.0, 16, by="lang")

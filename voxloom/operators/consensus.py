"""Choosing among transcript candidates: the one that the others agree with most.

All of it is expressions over an array of candidates (id, status, text) in their configured
order, so a row's candidates never leave the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_punctuation, is_blank, normalize_text, pair_distance
from ..schema import named, require

STATUSES = ("ok", "no_speech", "error")


def candidate(cid: str, status: Column, text: Column) -> Column:
    return F.struct(F.lit(cid).alias("id"), status.alias("status"), text.alias("text"))


def checked_candidate(cid: str, status: Column, text: Column) -> Column:
    """A candidate as stored; the job fails where the stored columns contradict each other."""
    fault = (
        F.when(status.isNull() | ~status.isin(*STATUSES), F.lit(f"candidate {cid}: unknown status"))
        .when(text.isNull(), F.lit(f"candidate {cid}: text is missing"))
        .when((status == "ok") & is_blank(text), F.lit(f"candidate {cid}: status ok with blank text"))
        .when((status != "ok") & (text != ""), F.lit(f"candidate {cid}: text without status ok"))
    )
    return F.when(fault.isNotNull(), F.raise_error(fault).cast("struct<id:string,status:string,text:string>")).otherwise(candidate(cid, status, text))


def select_candidate(df: DataFrame, candidates: Column, prefer_punctuated: bool = True, name: str = "selection") -> DataFrame:
    """df with a struct: eligible_ids, pairwise (array of ids and distance), means (a number for each
    eligible), medoid_id, selected_id, text, agreement, status, punctuation_ids, changed.

    Candidates of status ok with text are eligible. Distances are those of normalized texts;
    the medoid has the least mean distance, the first of equals. If it has no punctuation and
    others have, the nearest of those is selected. agreement is one less the medoid's
    mean, null for fewer than two."""
    eligible = F.transform(F.filter(candidates, lambda x: (x["status"] == "ok") & ~is_blank(x["text"])), lambda x: F.struct(x["id"].alias("id"), x["text"].alias("text"), normalize_text(x["text"]).alias("norm"), has_punctuation(x["text"]).alias("marked")))
    e, d, m = "_eligible", "_distances", "_means"
    df = df.withColumn(e, eligible)
    n = F.size(e)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    distance = lambda i, j: pair_distance(F.col(e)[i]["norm"], F.col(e)[j]["norm"])
    later = lambda i: F.filter(places, lambda j: j > i)
    pairs = F.flatten(F.transform(places, lambda i: F.transform(later(i), lambda j: F.struct(i.alias("i"), j.alias("j"), distance(i, j).alias("distance")))))
    df = df.withColumn(d, pairs)
    sums = lambda i: F.aggregate(F.filter(d, lambda p: (p["i"] == i) | (p["j"] == i)), F.lit(0.0), lambda s, p: s + p["distance"])
    df = df.withColumn(m, F.transform(places, lambda i: sums(i) / F.greatest(F.lit(1), n - 1)))
    first_of = lambda among: F.element_at(F.filter(places, lambda i: among(i) & (F.col(m)[i] == F.array_min(F.transform(F.filter(places, among), lambda k: F.col(m)[k])))), 1)
    medoid = F.when(n > 0, F.array_position(F.col(m), F.array_min(m)).cast("int") - 1)
    marked = lambda i: F.col(e)[i]["marked"]
    some_marked = F.exists(e, lambda x: x["marked"])
    chosen = F.when(F.lit(prefer_punctuated) & some_marked & ~F.col(e)[medoid]["marked"], first_of(marked)).otherwise(medoid) if prefer_punctuated else medoid
    df = df.withColumns({"_medoid": medoid, "_chosen": F.when(n > 0, chosen)})
    at = lambda place: F.col(e)[F.col(place)]
    out = F.struct(
        F.transform(e, lambda x: x["id"]).alias("eligible_ids"),
        F.transform(d, lambda p: F.struct(F.array(F.col(e)[p["i"]]["id"], F.col(e)[p["j"]]["id"]).alias("candidate_ids"), p["distance"].alias("distance"))).alias("pairwise"),
        F.col(m).alias("means"),
        at("_medoid")["id"].alias("medoid_id"), at("_chosen")["id"].alias("selected_id"), F.coalesce(at("_chosen")["text"], F.lit("")).alias("text"),
        F.when(n >= 2, F.greatest(F.lit(0.0), 1 - F.array_min(m))).alias("agreement"),
        F.when(n == 0, "no_candidate").when(n == 1, "single_candidate").otherwise("ok").alias("status"),
        F.transform(F.filter(e, lambda x: x["marked"]), lambda x: x["id"]).alias("punctuation_ids"),
        F.coalesce(F.col("_medoid") != F.col("_chosen"), F.lit(False)).alias("changed"),
    )
    return df.withColumn(name, out).drop(e, d, m, "_medoid", "_chosen")


def consensus_columns(df: DataFrame, candidates: list[tuple[str, str, str]], prefer_punctuated: bool = True, overwrite_text: bool = False) -> DataFrame:
    """The model-free reducer over stored candidates (id, status column, text column): df with
    consensus_* columns, lists as compact JSON. Ids must be distinct and columns present."""
    ids = [x for x, *_ in candidates]
    if not ids or len(set(ids)) != len(ids) or not all(ids):
        raise ValueError("candidate ids must be distinct and not empty")
    require(df, [x for _, *cols in candidates for x in cols], "consensus")
    found = select_candidate(df, F.array(*[checked_candidate(i, named(s), named(t)) for i, s, t in candidates]), prefer_punctuated, "_selection")
    s = F.col("_selection")
    out = found.withColumns({
        "consensus_medoid": F.coalesce(s["medoid_id"], F.lit("")), "consensus_selected": F.coalesce(s["selected_id"], F.lit("")), "consensus_text": s["text"],
        "consensus_eligible": F.to_json(s["eligible_ids"]), "consensus_pairwise": F.to_json(s["pairwise"]), "consensus_means": F.to_json(F.map_from_arrays(s["eligible_ids"], s["means"])),
        "consensus_agreement": s["agreement"], "consensus_punctuated": F.to_json(s["punctuation_ids"]), "consensus_changed": s["changed"], "consensus_status": s["status"],
    })
    if overwrite_text:
        out = out.withColumn("text", F.when(s["text"] != "", s["text"]).otherwise(F.col("text")))
    return out.drop("_selection")


def transcript_columns(df: DataFrame, texts: dict[str, Column], only_missing: bool = True, overwrite_text: bool = True, min_agreement: float | None = None, prefer_punctuated: bool = True) -> DataFrame:
    """Transcripts by several recognizers (null: the call failed) reduced to asr_text_<name>,
    asr_chosen_backend, asr_agreement and, with min_agreement, asr_low_confidence. With
    only_missing, rows that have a text keep it and get nulls."""
    todo = is_blank(F.col("text")) if only_missing else F.lit(True)
    status = lambda t: F.when(t.isNull(), "error").when(is_blank(t), "no_speech").otherwise("ok")
    found = select_candidate(df, F.array(*[candidate(k, status(t), F.coalesce(t, F.lit(""))) for k, t in texts.items()]), prefer_punctuated, "_selection")
    s = F.col("_selection")
    agreed = F.when(s["status"] == "no_candidate", 0.0).otherwise(F.coalesce(s["agreement"], F.lit(1.0)))
    new = {f"asr_text_{k}": F.when(todo, F.coalesce(t, F.lit(""))) for k, t in texts.items()}
    new |= {"asr_chosen_backend": F.when(todo, F.coalesce(s["selected_id"], F.lit(""))), "asr_agreement": F.when(todo, F.bround(agreed, 4))}
    if min_agreement is not None:
        new["asr_low_confidence"] = F.when(todo, agreed < min_agreement)
    if overwrite_text:
        new["text"] = F.when(todo & (s["text"] != ""), s["text"]).otherwise(F.col("text"))
    return found.withColumns(new).drop("_selection")

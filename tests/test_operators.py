"""Operators, sources, sinks, jobs, streaming and the report."""

import csv
import glob
import json
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.functions import signal
from voxloom.operators import consensus, metrics, quality, resume, scoring, spans, speakers
from voxloom.plans import job as jobs
from voxloom.plans.report import report
from voxloom.schema import CLIP_COLUMNS, ordered
from voxloom.sources import clips, sinks
from voxloom.streaming import clips as streams

CLIP = "id string, audio_file string, duration double, text string"


def clip_rows(spark, n=12):
    return spark.createDataFrame([(str(i), f"clips/{i}.wav", float(n - i), f"text {i}") for i in range(n)], CLIP)


# consensus


def pick(spark, candidates, **options):
    df = spark.createDataFrame([(candidates,)], "c array<struct<id:string,status:string,text:string>>")
    return consensus.select_candidate(df, F.col("c"), **options).first()["selection"]


def test_medoid_and_punctuation(spark):
    s = pick(spark, [("gigaam", "ok", "привет мир"), ("whisper", "ok", "Привет, мир!"), ("tone", "ok", "привет мир"), ("qwen3", "ok", "привет мир")])
    assert (s["medoid_id"], s["selected_id"], s["agreement"], s["changed"], s["status"]) == ("gigaam", "whisper", 1.0, True, "ok")
    assert s["text"] == "Привет, мир!" and s["punctuation_ids"] == ["whisper"] and len(s["pairwise"]) == 6


def test_ties_go_to_the_first(spark):
    s = pick(spark, [("a", "ok", "one"), ("b", "ok", "two")])
    assert s["medoid_id"] == "a" and s["means"][0] == s["means"][1]


def test_single_and_none(spark):
    s = pick(spark, [("a", "error", ""), ("b", "ok", "x"), ("c", "no_speech", "")])
    assert (s["status"], s["selected_id"], s["agreement"], s["eligible_ids"]) == ("single_candidate", "b", None, ["b"])
    s = pick(spark, [("a", "error", "")])
    assert (s["status"], s["selected_id"], s["text"]) == ("no_candidate", None, "")


@pytest.mark.parametrize("row", [("bad", "x"), ("ok", " "), ("error", "x"), ("ok", None), (None, "")])
def test_contradictions_fail(spark, row):
    df = spark.createDataFrame([row], "s string, t string")
    with pytest.raises(Exception, match="candidate a"):
        consensus.consensus_columns(df, [("a", "s", "t")]).collect()


def test_consensus_columns(spark):
    df = spark.createDataFrame([("ok", "а б", "ok", "а б", "старый")], "s1 string, t1 string, s2 string, t2 string, text string")
    r = consensus.consensus_columns(df, [("x", "s1", "t1"), ("y", "s2", "t2")], overwrite_text=True).first()
    assert r["text"] == "а б" and json.loads(r["consensus_pairwise"]) == [{"candidate_ids": ["x", "y"], "distance": 0.0}]
    assert json.loads(r["consensus_means"]) == {"x": 0.0, "y": 0.0} and r["consensus_eligible"] == '["x","y"]'
    with pytest.raises(ValueError, match="missing"):
        consensus.consensus_columns(df, [("x", "s1", "gone")])
    with pytest.raises(ValueError, match="distinct"):
        consensus.consensus_columns(df, [("x", "s1", "t1"), ("x", "s2", "t2")])


def test_only_missing(spark):
    df = spark.createDataFrame([("kept", "a b"), (" ", "a b")], "text string, heard string")
    got = consensus.transcript_columns(df, {"w": F.col("heard")}, min_agreement=0.5).collect()
    assert got[0]["text"] == "kept" and got[0]["asr_chosen_backend"] is None
    assert (got[1]["text"], got[1]["asr_agreement"], got[1]["asr_low_confidence"]) == ("a b", 1.0, False)


# scoring


def times(*args, **kw):
    """Workers can't import tests, so the class is made here and travels by value."""

    class Times(scoring.Scorer):
        outputs = {"val": "double"}

        def __init__(self, bad=(), memory=(), most=50):
            self.bad, self.memory, self.most_failures = bad, memory, most

        def score(self, model, clip):
            k = int(clip["id"])
            if k in self.bad:
                raise RuntimeError("no")
            if k in self.memory:
                raise RuntimeError("CUDA error: out of memory")
            return k * 10.0

        def recover(self, model, clip):
            return -float(clip["id"])

    return Times(*args, **kw)


@pytest.mark.parametrize("parts", [1, 4])
def test_scores_reach_their_rows(spark, parts):
    got = scoring.run_scorer(clip_rows(spark, 40).repartition(parts), times()).collect()
    assert {r["id"]: r["val"] for r in got} == {str(i): i * 10.0 for i in range(40)}


def test_guard(spark):
    got = {r["id"]: r for r in scoring.run_scorer(clip_rows(spark), times(bad=(3, 7), memory=(5,)), "why").collect()}
    assert math.isnan(got["3"]["val"]) and got["3"]["why"] == "inference_error" and math.isnan(got["7"]["val"])
    assert got["5"]["val"] == -5.0 and got["5"]["why"] is None and got["4"]["val"] == 40.0


def test_streak_stops_the_job(spark):
    with pytest.raises(Exception, match="unbroken row"):
        scoring.run_scorer(clip_rows(spark).coalesce(1), times(bad=tuple(range(12)), most=5)).collect()
    with pytest.raises(RuntimeError, match="rows failed"):
        scoring.failure_share(spark.range(4), F.col("id") > 0, 0.5)


def test_missing_packages(spark):
    class Needs(scoring.Scorer):
        requires = ("no_such_package",)

    with pytest.raises(ImportError, match="no_such_package"):
        scoring.run_scorer(clip_rows(spark), Needs())
    with pytest.raises(ImportError, match="backend"):
        metrics.model_metric(clip_rows(spark), "distillmos")


def test_registered_backend(spark):
    metrics.register(metrics.Backend("squim", None, lambda model, clip: (0.9, 3.0, float(len(clip["text"]))), requires=()))
    got = metrics.model_metric(clip_rows(spark), "squim").first()
    assert (got["pyt_stoi"], got["pyt_si_sdr"]) == (0.9, 6.0)
    metrics.register(metrics.Backend("squim", None, lambda model, clip: None, requires=()))
    assert metrics.model_metric(clip_rows(spark), "squim").first()["pyt_stoi"] == -1.0


def test_length_batches():
    assert scoring.length_batches([100.0, 1.0, 1.0], 10, 16) == [[1, 2], [0]]
    got = scoring.length_batches([1.0] * 10, 1000, 4)
    assert [len(g) for g in got] == [4, 4, 2]
    assert sorted(i for g in scoring.length_batches([3, 9, 2, 7], 12, 3) for i in g) == [0, 1, 2, 3]
    assert scoring.length_batches([], 1, 1) == []


def test_candidates(spark):
    class Ear(scoring.Recognizer):
        def transcribe(self, model, path):
            k = int(path.split("/")[1].split(".")[0])
            if k == 1:
                raise ImportError("x")
            return {0: "words", 2: "  ", 3: 5}.get(k, "w")

    got = {r["id"]: r for r in scoring.candidate_columns(clip_rows(spark, 5), Ear(), "ear").collect()}
    assert [got[str(i)]["asr_ear_status"] for i in range(5)] == ["ok", "error", "no_speech", "error", "ok"]
    assert (got["1"]["asr_ear_error_code"], got["3"]["asr_ear_error_code"], got["2"]["asr_ear_text"]) == ("dependency_error", "invalid_result", "")


def test_labelled(spark):
    df = spark.createDataFrame([([0.0, 2.0],)], "z array<double>")
    assert metrics.labelled(df, "z", ["m", "f"], "prob", "p", target="f").first()["p"] == pytest.approx(1 / (1 + math.exp(-2)))
    with pytest.raises(ValueError):
        metrics.labelled(df, "z", ["m", "f"], "label", ["a", "b"])


# spans


def test_alignment(spark):
    w = lambda *x: [("a", float(s), float(e)) for s, e in x]
    rows = [("t", w((0, 1), (1, 2)), "ok"), ("t", w((0, 1), (0.5, 2)), "error"), ("t", [], "error"), (" ", None, "empty_text"), ("t", w((0, 9)), "out_of_bounds"), ("t", [("", 0.0, 1.0)], "error"), ("t", w((2, 1)), "error"), ("t", w((0, math.nan)), "error")]
    df = spark.createDataFrame(rows, "text string, words array<struct<text:string,start:double,end:double>>, want string")
    for r in spans.alignment_columns(df, "text", "words", F.lit(40000), F.lit(16000)).collect():
        assert r["qwen3_alignment_status"] == r["want"]
        assert (r["qwen3_alignment"] == "[]") == (r["want"] in ("error", "empty_text"))


def test_diarization(spark):
    t = lambda *x: [("s" + str(k), float(a), float(b)) for k, a, b in x]
    rows = [
        (t((0, 0, 1)), t((0, 0, 1)), 1, {"x": 1.0}, False, "ok"), ([], t((0, 0, 1)), 0, {"x": 1.0}, False, "raw_only"), ([], [], 0, {"x": 1.0}, False, "error"),
        (t((0, 0, 1)), t((0, 0, 1)), 2, {"x": 1.0}, False, "error"), (t((0, 1, 1)), t((0, 0, 1)), 1, {"x": 1.0}, False, "error"), (t((0, 0, 1)), t((0, 0, 1)), 1, {}, False, "error"), (None, None, None, None, True, "no_speech"),
    ]
    turns = "array<struct<speaker:string,start:double,end:double>>"
    df = spark.createDataFrame(rows, f"m {turns}, r {turns}, n int, t map<string,double>, none boolean, want string")
    for r in spans.diarization_columns(df, "m", "r", "n", "t", F.col("none")).collect():
        assert r["senko_status"] == r["want"]


def test_silent_clips(spark):
    turns = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 1.0)], "id string, spk string, s double")
    got = speakers.silent_clips(spark.createDataFrame([("a",), ("b",)], "id string"), "id", speakers.diarization_summary(turns, "id", "spk", F.col("s")))
    assert sorted(map(tuple, got.collect())) == [("a", 2, 0.75), ("b", 0, 0.0)]


def test_cut_sentences(spark):
    data = signal.encode_wav(np.sin(np.arange(16000) / 9), 16000)
    df = spark.createDataFrame([(bytearray(data), 0.25, 0.75)], "content binary, start_timestamp double, end_timestamp double")
    assert signal.wav_header(bytes(sinks.cut_sentences(df).first()["audio"]))["frames"] == 8000


# speakers


def brute_linkage(x, limit):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - u @ u.T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        best = min(((np.mean([d[p, q] for p in a for q in b]), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        if not best[0] < limit:
            break
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("limit", [0.3, 0.6, 0.9])
def test_average_linkage(limit):
    rng = np.random.default_rng(int(limit * 10))
    x = rng.standard_normal((40, 5)) + 3 * np.eye(5)[rng.integers(0, 5, 40)]
    labels = speakers.average_linkage(x, limit)
    assert {frozenset(np.flatnonzero(labels == k).tolist()) for k in set(labels.tolist())} == brute_linkage(x, limit)


def test_cluster_sample_and_rest(spark):
    rng = np.random.default_rng(3)
    x = np.eye(4)[np.arange(60) % 4] + 0.05 * rng.standard_normal((60, 4))
    df = spark.createDataFrame([(str(i), [float(v) for v in row]) for i, row in enumerate(x)], "id string, e array<double>")
    for most in (5000, 30):
        got = {r["id"]: r["label"] for r in speakers.cluster_speakers(df, "id", "e", 0.5, most).collect()}
        assert len(got) == 60 and len(set(got.values())) == 4
        assert len({(int(i) % 4, v) for i, v in got.items()}) == 4
    labels = speakers.cluster_speakers(df, "id", "e")
    done = speakers.assign_speakers(df.join(labels, "id"), "id", "e", "label").collect()
    assert all(r["speaker"].startswith("spk_") and r["speaker_conf"] > 0.9 for r in done)


def test_one_speaker(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0], 0)], "id string, e array<double>, label int")
    r = speakers.assign_speakers(df, "id", "e", "label").first()
    assert (r["speaker"], r["speaker_conf"], r["speaker_margin"]) == ("spk_000", 1.0, 2.0)


# resuming


def test_checkpoint(spark, tmp_path):
    path = resume.checkpoint_path(str(tmp_path), "m", "val", {"k": 1})
    assert path != resume.checkpoint_path(str(tmp_path), "m", "val", {"k": 2})
    rows = spark.createDataFrame([("a", 1.5, "ok", "f1"), ("b", math.nan, "ok", "f2"), ("c", 2.0, "error", "f3")], "id string, val double, status string, input_fingerprint string")
    resume.append_checkpoint(rows, path, ["val"], F.col("status") != "error")
    time.sleep(1.1)
    resume.append_checkpoint(rows.where("id = 'a'").withColumn("val", F.lit(9.0)), path, ["val"])
    with open(f"{path}/torn.json", "w") as f:
        f.write('{"id":"z","va')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("val", T.DoubleType()), T.StructField("input_fingerprint", T.StringType())])
    got = {r["id"]: r["val"] for r in resume.read_checkpoint(spark, path, schema).collect()}
    assert got["a"] == 9.0 and math.isnan(got["b"]) and set(got) == {"a", "b"}
    cached = resume.read_checkpoint(spark, path, schema)
    clips_ = spark.createDataFrame([("a", "f1"), ("b", "changed"), ("d", "f4")], "id string, input_fingerprint string")
    assert {r["id"] for r in resume.todo(clips_, cached, fingerprint="input_fingerprint").collect()} == {"b", "d"}
    done = resume.resume(clips_, cached, lambda rest: rest.withColumn("val", F.lit(-1.0)), ["val"], fingerprint="input_fingerprint")
    assert {r["id"]: r["val"] for r in done.collect()} == {"a": 9.0, "b": -1.0, "d": -1.0}


def test_merge_first(spark):
    a = spark.createDataFrame([("a", "1"), ("b", "1"), ("", "1"), (None, "1")], "id string, text string")
    b = spark.createDataFrame([("b", "2", 5), ("c", "2", 5), ("", "2", 5)], "id string, text string, late int")
    got = resume.merge_first([a, b])
    assert got.columns == ["id", "text"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", "1"), ("b", "1"), ("c", "2"), ("", "1"), ("", "2"), (None, "1")]))


def test_extend_and_join(spark):
    old = spark.createDataFrame([("a", 1)], "id string, x int")
    new = resume.extend(old, spark.createDataFrame([("a",), ("b",)], "id string"), lambda d: d.withColumn("x", F.lit(2)))
    assert sorted(map(tuple, new.collect())) == [("a", 1), ("b", 2)]
    assert resume.join_runs([old, old.select("id", F.lit(7).alias("y"))]).columns == ["id", "x", "y"]


# sources and sinks


def read_plain(folder):
    out = []
    for f in sorted(glob.glob(f"{folder}/*.csv")):
        with open(f, encoding="utf-8", newline="") as h:
            out += list(csv.DictReader(h, delimiter="|"))
    return out


def test_csv_dialect(spark, tmp_path):
    text = 'a|b "quoted", ё\nnext'
    df = spark.createDataFrame([("1", "x.wav", text, None, [("s", 0.5)]), ("2", "y.wav", "", "z", [])], "id string, audio_file string, text string, extra string, spans array<struct<speaker:string,start:double>>")
    sinks.write_csv(df, f"{tmp_path}/c", declared=["late", "extra"])
    rows = {r["id"]: r for r in read_plain(f"{tmp_path}/c")}
    assert list(rows["1"]) == ["id", "audio_file", "text", "extra", "spans", "late"]
    assert rows["1"]["text"] == text and rows["2"]["text"] == "" and rows["1"]["late"] == "" and json.loads(rows["1"]["spans"]) == [{"speaker": "s", "start": 0.5}]
    back = {r["id"]: r for r in clips.read_csv(spark, f"{tmp_path}/c").collect()}
    assert back["1"]["text"] == text and back["2"]["text"] == "" and back["1"]["path"] == "x.wav"


def test_adapter(spark, tmp_path):
    with open(f"{tmp_path}/metadata.csv", "w") as f:
        f.write("audio_path|sample_rate|channels|duration|distillmos|metadata\na.wav|44100|x|1.5|3.25|{'gender': 'f'}\n|1|1|1||\nb.wav||2|abc||\n")
    df = clips.read_csv(spark, f"{tmp_path}/metadata.csv", audio_key="audio_path", root="/data/set", defaults={"dataset": "d"})
    got = df.orderBy("path").collect()
    assert [r["audio_file"] for r in got] == ["/data/set/a.wav", "/data/set/b.wav"]
    assert (got[0]["sample_rate"], got[0]["channels"], got[0]["duration"], got[0]["distillmos"], got[0]["gender"]) == (44100, None, 1.5, "3.25", "f")
    assert got[0]["dataset"] == "d" and got[0]["id"].endswith("metadata.csv/0") and got[1]["id"].endswith("/2") and got[1]["text"] == ""
    assert clips.read_csv(spark, f"{tmp_path}/metadata.csv", audio_key="audio_path", limit=1).count() == 1
    assert set(CLIP_COLUMNS) <= set(df.columns)


def test_jsonl(spark, tmp_path):
    with open(f"{tmp_path}/m.jsonl", "w") as f:
        f.write('{"id":"1","audio_file":"a.wav","text":"ё"}\nnot json\n{"id":"2","audio_file":"b.wav"}\n')
    assert {r["id"]: r["text"] for r in clips.read_jsonl(spark, f"{tmp_path}/m.jsonl", "id string, audio_file string, text string").collect()} == {"1": "ё", "2": ""}
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert clips.bad_lines(spark, f"{tmp_path}/m.jsonl", schema).count() == 1
    sinks.write_jsonl(spark.createDataFrame([("1", 0.0, "")], "id string, duration double, text string").coalesce(1), f"{tmp_path}/out")
    assert len(glob.glob(f"{tmp_path}/out/*.gz")) == 1


def wavs(tmp_path, n=4):
    (tmp_path / "audio").mkdir()
    rows = []
    for i in range(n):
        rate = (16000, 22050, 44100)[i % 3]
        x = 0.4 * np.sin(2 * np.pi * (110, 180, 240)[i % 3] * np.arange(rate) / rate)
        (tmp_path / "audio" / f"c{i}.wav").write_bytes(signal.encode_wav(x, rate))
        if i % 2 == 0:
            (tmp_path / "audio" / f"c{i}.txt").write_text(f"line {i}\nmore")
        rows.append(f"{i}|audio/c{i}.wav|{'' if i % 3 == 0 else 'some words here'}")
    (tmp_path / "metadata.csv").write_text("id|audio_path|text\n" + "\n".join(rows) + "\n")


def test_folder(spark, tmp_path):
    wavs(tmp_path)
    assert clips.read_folder(spark, f"{tmp_path}/audio").count() == 4
    got = clips.read_folder(spark, f"{tmp_path}/audio", text_ending=".txt").orderBy("audio_file").collect()
    assert [r["text"] for r in got] == ["line 0more", "line 2more"] and got[0]["id"].endswith("c0.wav/0") and got[0]["format"] == "wav"
    assert clips.file_pattern(".wav") == "*.wav" and clips.file_pattern("a.csv") == "a.csv"


def test_export(spark, tmp_path):
    spark.createDataFrame([("1", ("x.wav", 8000), "t")], "id string, audio struct<path:string,sampling_rate:int>, text string").write.parquet(f"{tmp_path}/p")
    r = clips.read_export(spark, f"{tmp_path}/p", "set").first()
    assert (r["audio_file"], r["sample_rate"], r["dataset"]) == ("x.wav", 8000, "set")


def test_names_and_order(spark):
    assert sinks.file_name("ext_$rank.csv", 7) == "ext_00007.csv"
    df = spark.createDataFrame([("de", "t", "i")], "dataset string, text string, id string")
    assert df.select(sinks.file_name_column("$dataset.csv", df)).first()[0] == "de.csv"
    assert ordered(df, ["mos"]).columns == ["id", "text", "dataset", "mos"]


# jobs


JOB = """
name: tones
reader: {{type: csv, path: {root}/metadata.csv, audio_key: audio_path, root: {root}, with_content: true, content_root: {root}/audio}}
steps:
  - lanes:
      cpu: [{{step: signal, wanted: [bandwidth, pitch, style]}}]
      text: [{{step: speaking_rate}}]
  - {{step: reasons, distillmos: 3.0}}
writer: {{type: csv, path: {root}/out}}
checkpoints: {root}/kept
"""


def test_job(spark, tmp_path):
    wavs(tmp_path)
    job = jobs.parse_job(JOB.format(root=tmp_path))
    for _ in range(2):  # the second run finds everything done
        jobs.run_job(spark, job)
        rows = {r["id"]: r for r in read_plain(f"{tmp_path}/out")}
        assert [float(rows[str(i)]["pitch_mean"]) for i in range(3)] == pytest.approx([110, 180, 240], rel=0.01)
        assert float(rows["1"]["duration"]) == 1.0 and float(rows["1"]["char_rate"]) == 15.0 and "no_text" in rows["0"]["reasons"]
        assert rows["0"]["audio_file"] == "audio/c0.wav"
    assert sinks.is_done(spark, f"{tmp_path}/out") and sinks.unfinished(spark, {"a": f"{tmp_path}/out", "b": f"{tmp_path}/no"}) == ["b"]


def test_job_checks(tmp_path, monkeypatch):
    base = "reader: {type: csv, path: x}\nwriter: {type: csv, path: '${OUT:y}'}\nsteps: "
    assert jobs.parse_job(base + "[]").writer["path"] == "y"
    monkeypatch.setenv("OUT", "z")
    assert jobs.parse_job(base + "[]", **{"reader.limit": 5}).reader["limit"] == 5
    for steps in ("[{step: nothing}]", "[{step: speaking_rate, x: 1}]"):
        with pytest.raises(ValueError):
            jobs.parse_job(base + steps)
    with pytest.raises(ValueError, match="reader"):
        jobs.parse_job("steps: []")
    lanes = [{"lanes": {"a": [{"step": "speaking_rate"}], "b": [{"step": "speaking_rate"}]}}]
    with pytest.raises(ValueError, match="both write"):
        jobs.check_steps(lanes, ["text", "duration"])
    with pytest.raises(ValueError, match="nothing before"):
        jobs.check_steps([{"step": "word_errors", "transcript": "heard"}], ["text"])
    assert jobs.declared(lanes) == ["speaking_rate", "phonemes_per_word", "char_rate"]
    with pytest.raises(ValueError):
        jobs.revision("main")


def test_generated_jobs_parse():
    for p in (jobs.Profile(), jobs.Profile(False, False, True, True, True)):
        job = jobs.parse_job(jobs.job_for("d", "d/metadata.csv", "out", p))
        assert "bandwidth_hz" in jobs.declared(job.steps)


def test_sweep(spark, tmp_path):
    for name, n in (("big", 30), ("small", 3)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.csv").write_text("id|audio_file|text|duration\n" + "\n".join(f"{i}|a.wav|t t|2" for i in range(n)) + "\n")
    seen = []

    def make(name, path):
        seen.append(name)
        return jobs.Job({"type": "csv", "path": path}, {"type": "parquet", "path": f"{tmp_path}/out/{name}"}, [{"step": "speaking_rate"}] if name == "big" else [{"step": "word_errors", "transcript": "gone"}])

    out = jobs.sweep(spark, str(tmp_path), make, lambda name: f"{tmp_path}/out/{name}")
    assert seen == ["small", "big"] and out["big"] == "done" and out["small"].startswith("failed")
    assert jobs.sweep(spark, str(tmp_path), make, lambda name: f"{tmp_path}/out/{name}")["big"] == "skipped"


def test_plain_functions_are_steps(spark):
    assert jobs.apply_steps(clip_rows(spark), [lambda df: df.limit(2), {"step": "speaking_rate"}]).count() == 2


# report and streaming


def test_report(spark):
    df = clip_rows(spark).withColumns({"distillmos": F.col("duration") / 3, "dataset": F.lit("d"), "speaker_id": F.lit("<s>")})
    page = report(df, "A & B", samples=2)
    assert "A &amp; B" in page and "<svg" in page and "12 clips" in page and "mos" in page


def test_empty_table(spark):
    none = clip_rows(spark).where("false")
    assert quality.summary(none).first()["clips"] == 0 and quality.reason_counts(none).count() == 0
    assert quality.nearest_rank(none, "duration", [0.5]).count() == 0
    assert "0 clips" in report(none, "none")


def test_stream(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = spark.createDataFrame([("a", 60.0), ("b", 60.0)], "id string, duration double")
    rows.coalesce(1).write.json(src)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("duration", T.DoubleType())])
    for _ in range(2):
        q = streams.annotate(streams.once_by_id(streams.stream_clips(spark, src, schema)), lambda b: b.withColumn("x", F.lit(1)), out, f"{tmp_path}/cp")
        q.awaitTermination(120)
        rows.coalesce(1).write.mode("append").json(src)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]
    counts = streams.windowed_counts(streams.stream_clips(spark, src, schema))
    assert counts.isStreaming and counts.columns == ["window", "clips", "hours"]


# what files and rows really hold


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id|audio_file|text|dataset\n1|a.wav|one|d1\n")
    (tmp_path / "b [x] 1.csv").write_text("audio_file|id|dataset|text|more\nb.wav|2|d2|two|m\n")
    got = {r["id"]: r for r in clips.read_csv(spark, str(tmp_path)).collect()}
    assert (got["1"]["audio_file"], got["1"]["text"], got["1"]["dataset"], got["1"]["more"]) == ("a.wav", "one", "d1", None)
    assert (got["2"]["audio_file"], got["2"]["text"], got["2"]["dataset"], got["2"]["more"]) == ("b.wav", "two", "d2", "m")
    with pytest.raises(Exception, match="header"):
        clips.read_csv(spark, str(tmp_path), one_header=True).collect()


def test_limit_takes_the_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id|audio_file\n" + "".join(f"{i}|{'' if i == 1 else f'{i}.wav'}\n" for i in range(50)))
    assert [r["id"] for r in clips.read_csv(spark, str(tmp_path), limit=3).orderBy("id").collect()] == ["0", "2", "3"]


def test_metadata_cells(spark):
    cells = ['{"k": "v"}', "{'title': \"it's\", 'n': 3, 'none': None, 'yes': True}", "neither", None, ""]
    df = spark.createDataFrame([(str(i), "a.wav", c) for i, c in enumerate(cells)], "id string, audio_file string, metadata string")
    got = {r["id"]: r.asDict() for r in clips.adapt(df).collect()}
    assert got["0"]["k"] == "v" and (got["1"]["title"], got["1"]["n"], got["1"]["none"], got["1"]["yes"]) == ("it's", "3", None, "True")
    assert got["2"]["metadata"] == "neither" and got["3"]["metadata"] is None and got["0"]["metadata"] is None


def test_nan_passes_a_scorer(spark):
    df = spark.createDataFrame([("a", float("nan"), [1.0, None], b"\x00"), ("b", None, None, None)], "id string, prev double, list array<double>, content binary")
    first = scoring.FunctionScorer(lambda c: float("nan"), {"one": "double"}, inputs=("id",))
    second = scoring.FunctionScorer(lambda c: 1.0 if c["id"] == "a" else "x", {"two": "double"}, inputs=("id",))
    rows = {r["id"]: r for r in scoring.run_scorer(scoring.run_scorer(df, first), second, "error").collect()}
    assert math.isnan(rows["a"]["prev"]) and rows["b"]["prev"] is None and math.isnan(rows["a"]["one"]) and math.isnan(rows["b"]["one"])
    assert rows["a"]["two"] == 1.0 and math.isnan(rows["b"]["two"]) and rows["b"]["error"] == "invalid_result"
    assert rows["a"]["list"] == [1.0, None] and bytes(rows["a"]["content"]) == b"\x00"


def test_clusters_of_more_rows_than_are_fitted(spark):
    """All rows in rounds, as average linkage labels them at once; a speaker whom the first round lacks
    isn't merged into another."""
    rng = np.random.default_rng(2)
    centers = np.linalg.qr(rng.standard_normal((24, 24)))[0][:12]
    of = np.r_[rng.integers(0, 11, 1180), np.full(3, 11)]
    vectors = centers[of] + rng.standard_normal((len(of), 24)) * 0.02
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")
    got = {r["id"]: r["label"] for r in speakers.cluster_speakers(df, "id", "v", 0.5, most=100).collect()}
    want = speakers.average_linkage(vectors, 0.5)
    assert len(got) == len(of) and len({(got[i], int(want[i])) for i in range(len(of))}) == len(set(got.values())) == len(set(want.tolist())) == 12
    with pytest.raises(ValueError, match="centroids"):
        speakers.assign_speakers(df.withColumn("label", F.col("id")), "id", "v", "label", most_centers=100)


def test_length_batches_across_tasks(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], float((i * 37) % 50)) for i in range(200)], "id long, lane string, s double")
    for parts in (1, 7):
        got = {r["id"]: r["batch"] for r in scoring.batches_of(df.repartition(parts), "id", "s", 60.0, 8, by="lane").collect()}
        for lane in (0, 1):
            ids = sorted((i for i in range(200) if i % 2 == lane), key=lambda i: ((i * 37) % 50, i))
            groups = scoring.length_batches([float((i * 37) % 50) for i in ids], 60.0, 8)
            assert [got[i] for i in ids] == [n for n, g in enumerate(groups) for _ in g]


# jobs that go on where others stopped, and models behind adapters


def test_jobs_resume(spark, tmp_path, monkeypatch):
    class Recorder(scoring.Scorer):
        """Writes down the ids it scores, in a folder; fails where the text says so."""

        inputs, outputs = ("text",), {"transcript": "string"}

        def __init__(self, folder):
            self.folder = folder

        def score(self, model, clip):
            with open(f"{self.folder}/{clip['id']}", "a") as f:
                f.write("x")
            if clip["text"] == "broken":
                raise RuntimeError("broken")
            return clip["text"].upper()

    calls = tmp_path / "calls"
    calls.mkdir()
    monkeypatch.setitem(metrics._backends, "whisper", Recorder(str(calls)))
    seen = lambda: {p.name: len(p.read_text()) for p in calls.iterdir()}
    job = jobs.parse_job(f"""
name: go_on
reader: {{type: parquet, path: "{tmp_path}/in"}}
checkpoints: {tmp_path}/kept
fingerprint: [text]
steps:
  - {{step: candidate, backend: whisper, name: w}}
writer: {{type: parquet, path: "{tmp_path}/out"}}
""")

    def run(texts):
        spark.createDataFrame([(str(i), f"{i}.wav", t) for i, t in enumerate(texts)], "id string, audio_file string, text string").write.mode("overwrite").parquet(f"{tmp_path}/in")
        jobs.run_job(spark, job)
        return {r["id"]: (r["asr_w_status"], r["asr_w_text"], r["asr_w_error_code"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    first = run(["a", "b", "broken", " "])
    assert first == {"0": ("ok", "A", ""), "1": ("ok", "B", ""), "2": ("error", "", "inference_error"), "3": ("no_speech", "", "")}
    before = seen()
    # one text is new, one is mended, one clip more; the rest isn't scored again, errors are
    second = run(["a", "changed", "mended", " ", "e"])
    assert second == {"0": ("ok", "A", ""), "1": ("ok", "CHANGED", ""), "2": ("ok", "MENDED", ""), "3": ("no_speech", "", ""), "4": ("ok", "E", "")}
    now = seen()
    assert now["0"] == before["0"] and now["3"] == before["3"] and now["1"] > before["1"] and now["2"] > before["2"]
    assert run(["a", "changed", "mended", " ", "e"]) == second and seen() == now
    with pytest.raises(ValueError, match="several rows"):
        jobs.run_job(spark, jobs.Job(job.reader, job.writer, [{"step": "sentences"}], checkpoints="x"))


def test_presets_are_jobs(spark):
    from voxloom.operators import backends

    backends.register_all("cpu", {"audio_model": {"model": "m"}})
    columns = ["id", "audio_file", "text", "duration", "sample_rate", "content", *[f"asr_{x}_{y}" for x in ("gigaam", "whisper", "tone", "qwen3") for y in ("status", "text")]]
    names = sorted(p.stem for p in jobs.PRESETS.glob("*.yaml"))
    assert {"annotate", "annotate_candidate", "consensus", "align", "diarize", "quality"} <= set(names)
    for name in names:
        job = jobs.preset(name, **{"reader.limit": 10})
        jobs.check_steps(job.steps, columns)
        assert job.reader["limit"] == 10 and jobs.declared(job.steps) or name == "consensus"


def test_recognizers_that_are_missing_count_as_failed(spark, monkeypatch):
    class Gone(scoring.Recognizer):
        def load(self):
            raise ModuleNotFoundError("gone")

    class Absent(scoring.Recognizer):
        requires = ("no_such_package",)

    class Here(scoring.Recognizer):
        def transcribe(self, model, path):
            return "Привет, мир!"

    for name, s in (("asr_gigaam", Gone()), ("asr_tone", Absent()), ("whisper", Here())):
        monkeypatch.setitem(metrics._backends, name, s)
    df = spark.createDataFrame([(str(i), f"{i}.wav", t) for i, t in enumerate(["", "has one"] * 40)], "id string, audio_file string, text string")
    for r in metrics.transcribed(df, ["asr_gigaam", "asr_tone", "whisper"], min_agreement=0.5).collect():
        if int(r["id"]) % 2:
            assert r["text"] == "has one" and r["asr_chosen_backend"] is None
        else:
            assert (r["text"], r["asr_chosen_backend"], r["asr_agreement"], r["asr_text_gigaam"], r["asr_low_confidence"]) == ("Привет, мир!", "whisper", 1.0, "", False)


def test_alignment_diarization_and_sentences_as_steps(spark, monkeypatch):
    word = lambda t, a, b: {"text": t, "start": a, "end": b}
    monkeypatch.setitem(metrics._backends, "qwen3_alignment", scoring.FunctionScorer(lambda c: [word("а", 0.0, 0.5), word("б", 0.5, 1.0)] if c["id"] == "0" else 1 / 0, {"words": metrics.MODELS["qwen3_alignment"].columns["words"]}))
    turn = {"speaker": "A", "start": 0.0, "end": 1.0}
    monkeypatch.setitem(metrics._backends, "senko", scoring.FunctionScorer(lambda c: ([turn], [turn], 1, {"all": 0.1}) if c["id"] == "0" else (None,) * 4, metrics.MODELS["senko"].columns))
    df = spark.createDataFrame([("0", "d/a.wav", "а б", 1.0, 16000), ("1", "d/b.wav", "в", 1.0, 16000)], "id string, audio_file string, text string, duration double, sample_rate int")
    got = {r["id"]: r for r in jobs.apply_steps(df, [{"step": "align"}, {"step": "diarize"}]).collect()}
    assert (got["0"]["qwen3_alignment_status"], got["1"]["qwen3_alignment_status"]) == ("ok", "error") and json.loads(got["0"]["qwen3_alignment"])[1] == word("б", 0.5, 1.0)
    assert (got["0"]["senko_status"], got["1"]["senko_status"], got["0"]["senko_num_speakers"]) == ("ok", "no_speech", 1)
    words = [(" One", 0.0, 0.4), (" two.", 0.5, 1.0), (" Three!", 2.0, 2.5), (" rest", 3.0, 3.2)]
    df = spark.createDataFrame([("0", "d/a.wav", 4.0, words)], "id string, audio_file string, duration double, words array<struct<word string, start double, end double>>")
    rows = jobs.apply_steps(df, [{"step": "sentences", "folder": "cuts"}]).orderBy("sentence").collect()
    assert [(r["text"], r["audio_file"]) for r in rows] == [("One two.", "cuts/a_00000000.wav"), ("Three!", "cuts/a_00000001.wav")]


def test_adapters(monkeypatch):
    """The rules around models, with stand-ins for the models' packages."""
    import sys
    import types

    from voxloom.operators import backends as b

    tone = lambda seconds: {"id": "1", "audio_file": "x.wav", "text": "Привет, мир", "content": signal.encode_wav(np.sin(np.arange(int(16000 * seconds)) / 9) / 2, 16000)}
    assert b.Squim("cpu").values(None, np.zeros(1023, np.float32), {}) == (-1.0, -1.0, -1.0)
    tried = []

    class WhisperModel:
        def __init__(self, name, device, compute_type):
            tried.append(compute_type)
            if compute_type == "int8_float16":
                raise ValueError("no such arithmetic")

        def transcribe(self, x, language=None, **more):
            return [types.SimpleNamespace(text=" a "), types.SimpleNamespace(text=""), types.SimpleNamespace(text=" b")], None

    monkeypatch.setitem(sys.modules, "faster_whisper", types.SimpleNamespace(WhisperModel=WhisperModel))
    w = b.Whisper("cuda")
    assert w.score(w.load(), tone(0.2)) == ("a b",) and tried == ["int8_float16", "int8_float32"]
    g = b.GigaAm("cpu")
    assert len(g.cut(tone(30))) == int(24.9 * 16000)
    assert g.row(tone(1), "привет мир", []) == ("привет мир", 0.0) and g.row({"text": ""}, "x", [])[1] == -1.0
    assert b.Punctuated("cpu").row({"text": "привет мир"}, "Привет, мир!", []) == ("привет, мир!",)
    assert json.loads(b.word_json([types.SimpleNamespace(text="а", start=0.12345, end=1.0)])) == [{"text": "а", "start": 0.123, "end": 1.0}]

    class Mean(b.Adapter):
        metric = "distillmos"

        def values(self, model, samples, clip):
            return (float(len(samples)),)

    assert Mean("cpu").recover(None, tone(50)) == (pytest.approx(800_000 / 3),)
    assert b.plain_text({"text": "x"}) == "x" and b.plain_text(types.SimpleNamespace(text="y")) == "y"
    with pytest.raises(TypeError):
        b.plain_text(3)
    assert {a.metric for a in b.ADAPTERS} <= set(metrics.MODELS)


def test_recordings_are_cut_into_files(spark, tmp_path, monkeypatch):
    words = [{"word": " One", "start": 0.2, "end": 0.4}, {"word": " two.", "start": 0.5, "end": 0.9}, {"word": " Three!", "start": 2.0, "end": 2.5}]
    monkeypatch.setitem(metrics._backends, "whisper_words", scoring.FunctionScorer(lambda c: words, metrics.MODELS["whisper_words"].columns, inputs=("id",)))
    tone = signal.encode_wav(np.zeros(48_000), 16_000)
    df = spark.createDataFrame([(str(i), f"d/{i}.wav", 3.0, bytearray(tone)) for i in range(3)], "id string, audio_file string, duration double, content binary")
    rows = jobs.apply_steps(df, [{"step": "model", "metric": "whisper_words"}, {"step": "sentences", "folder": f"{tmp_path}/cuts"}, {"step": "cuts"}]).collect()
    assert len(rows) == 6 and {r["text"] for r in rows} == {"One two.", "Three!"}
    for r in rows:
        x, rate = signal.load(open(r["audio_file"], "rb").read())
        assert rate == 16_000 and abs(len(x) / rate - (min(3.0, r["end_timestamp"]) - r["start_timestamp"])) < 0.01
    assert len(glob.glob(f"{tmp_path}/cuts/*")) == 6


def test_a_lane_that_fails_is_named(spark, monkeypatch):
    monkeypatch.delitem(metrics._backends, "squim", raising=False)
    with pytest.raises(ImportError, match="lane models: squim needs a backend"):
        jobs.apply_steps(clip_rows(spark), [{"lanes": {"rates": [{"step": "speaking_rate"}], "models": [{"step": "model", "metric": "squim"}]}}])

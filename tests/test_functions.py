"""Functions on literal values, with what they must give."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import arrays, numbers, signal, text


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize(
    ("given", "want"),
    [("Hello   WORLD\n", "hello world"), ("Привет, «мир» — как дела?", "привет мир как дела"), ("hello (laughs) <noise> world", "hello world"), ("", ""), ("snake_case-word", "snake case word")],
)
def test_normalize(spark, given, want):
    assert values(spark, [(given,)], "t string", text.normalize_text(F.col("t"))) == [(want,)]


def test_error_rates(spark):
    wer, cer = text.error_rates(F.col("a"), F.col("b"))
    rows = [("a b c d e", "a x c e"), ("привет", "превед"), ("", "x"), (None, "x"), ("abc", None)]
    got = values(spark, rows, "a string, b string", wer, cer)
    assert got[0] == (0.4, 4 / 9) or got[0][0] == 0.4
    assert got[1] == (1.0, 2 / 6) and got[2] == got[3] == (-1.0, -1.0) and got[4] == (1.0, 1.0)


def test_pair_distance(spark):
    rows = [("", ""), ("", "a"), ("ab", "ab"), ("ab", "abcd"), ("a", "zzzzzz")]
    got = values(spark, rows, "a string, b string", text.pair_distance(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [0.0, 1.0, 0.0, 0.75, 1.0]


def test_trailing_punctuation(spark):
    (got,) = values(spark, [("Привет, мир?! -- ok... ,. x",)], "t string", text.split_trailing_punct(F.col("t")))[0]
    assert [(p["word"], p["mark"]) for p in got] == [("Привет", ","), ("мир", "!"), ("--", ""), ("ok", "."), ("x", "")]


@pytest.mark.parametrize(
    ("reference", "hypothesis", "want", "share"),
    [
        ("ты придешь сегодня вечером домой", "Ты придёшь сегодня вечером домой?", "ты придешь сегодня вечером домой?", 1.0),
        ("раз два три", "Раз, два, три", "раз, два, три.", 1.0),
        ("один два три четыре", "совсем другие слова тут", None, 0.0),
        ("", "x", None, 0.0),
        ("слово", "", None, 0.0),
    ],
)
def test_punctuation_transfer(spark, reference, hypothesis, want, share):
    df = spark.createDataFrame([(reference, hypothesis)], "a string, b string")
    assert tuple(df.select(text.transfer_punctuation()("a", "b").alias("m")).select("m.*").first()) == (want, share)


def test_counts_and_blanks(spark):
    got = values(spark, [("  Привет мир_1  ",), (None,), (" ",)], "t string", text.char_count(F.col("t")), text.word_count(F.col("t")), text.is_blank(F.col("t")))
    assert got == [(12, 2, False), (None, None, True), (0, 0, True)]


def test_word_key_and_joins(spark):
    assert values(spark, [("Ёлка-1é",)], "t string", text.word_key(F.col("t"))) == [("елка1",)]
    assert values(spark, [([" a ", "", None, "b"],)], "s array<string>", text.join_segments(F.col("s"))) == [("a b",)]


def test_numbers(spark):
    rows = [("1.5",), ("nan",), ("inf",), ("1.5d",), ("x",), ("",), (None,)]
    got = [v[0] for v in values(spark, rows, "v string", numbers.parse_number(F.col("v")))]
    assert got[0] == 1.5 and math.isnan(got[1]) and got[2] == math.inf and got[3:] == [None] * 4
    assert values(spark, [(7, 9), (0, 0)], "a long, b long", numbers.percent_floor(F.col("a"), F.col("b"))) == [(77,), (0,)]


def test_endpoint(spark):
    end = numbers.endpoint_within(F.col("e"), F.col("n"), F.col("r"))
    assert values(spark, [(1.08, 16000, 16000), (1.0800001, 16000, 16000), (1.0, 16000, 16000)], "e double, n long, r int", end) == [(True,), (False,), (True,)]


def test_wada_matches_numpy(spark):
    rng = np.random.default_rng(0)
    clips = [rng.standard_normal(500) * s for s in (0.1, 1.0)] + [np.sin(np.arange(300) / 5), np.r_[np.zeros(400), 1.0]]
    rows = [([float(x) for x in c],) for c in clips] + [([0.0, 0.0],), ([],)]
    got = [v[0] for v in values(spark, rows, "x array<double>", numbers.wada_snr(F.col("x")))]
    assert got[:4] == pytest.approx([signal.wada_snr(c) for c in clips], abs=1e-9)
    assert math.isnan(got[4]) and got[5] is None


def test_vectors(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])]
    got = values(spark, rows, "a array<double>, b array<double>", numbers.cosine(F.col("a"), F.col("b")), numbers.unit_vector(F.col("a")))
    assert got == [(pytest.approx(0.96), [0.6, 0.8]), (0.0, [0.0, 0.0])]


def test_windows(spark):
    rows = [([float(i) for i in range(10)],), ([1.0, 2.0],), ([],)]
    got = [v[0] for v in values(spark, rows, "x array<double>", arrays.windows(F.col("x"), 1, 3.0))]
    assert [[len(w) for w in g] for g in got] == [[3, 3, 3, 1], [2], [0]]


def test_softmax_and_std(spark):
    got = values(spark, [([1.0, 3.0, 3.0],)], "x array<double>", arrays.label_and_score(F.col("x"), ["a", "b", "c"]), arrays.array_std(F.col("x")), arrays.array_std(F.col("x"), sample=True))[0]
    assert got[0]["label"] == "b" and got[0]["score"] == pytest.approx(1 / (2 + math.exp(-2)))
    assert got[1:] == (pytest.approx(np.std([1, 3, 3])), pytest.approx(np.std([1, 3, 3], ddof=1)))


def test_identity_and_mime(spark):
    assert arrays.identity_hash({"a": 1, "b": 2}) == arrays.identity_hash({"b": 2, "a": 1}) != arrays.identity_hash({"a": 1})
    got = values(spark, [("x/y.FLAC", b"ab"), ("z", b"")], "p string, c binary", arrays.mime_type(F.col("p")), arrays.data_url(F.col("c"), F.col("p")), arrays.file_stem(F.col("p")))
    assert got == [("audio/flac", "data:audio/flac;base64,YWI=", "y"), ("audio/wav", "data:audio/wav;base64,", "z")]


# signals


def tone(hz, rate=16000, seconds=1.0, level=0.5):
    return level * np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


def test_wav_round_trip():
    x = tone(440)
    back, rate = signal.decode_wav(signal.encode_wav(x, 16000))
    assert rate == 16000 and back.shape == (1, 16000) and np.abs(back[0] - x).max() < 1e-4
    assert signal.wav_header(signal.encode_wav(x, 16000)) == {"frames": 16000, "sample_rate": 16000, "channels": 1, "bit_rate": "256000", "duration": 1.0}
    assert signal.wav_header(b"nonsense") is None


@pytest.mark.parametrize("hz", [110, 180, 240, 440])
@pytest.mark.parametrize("rate", [16000, 22050, 44100])
def test_pitch(hz, rate):
    mean, std = signal.pitch_stats(tone(hz, rate), rate)
    assert mean == pytest.approx(hz, rel=0.01) and std < 0.01 * hz


def test_silence_and_short():
    assert signal.pitch_stats(np.zeros(16000), 16000) == (0.0, 0.0)
    assert signal.bandwidth(np.zeros(100), 16000) == (0.0, False)
    assert math.isnan(signal.wada_snr(np.zeros(10)))
    with pytest.raises(ValueError):
        signal.wada_snr(np.zeros(0))


def test_bandwidth():
    rng = np.random.default_rng(1)
    noise = rng.standard_normal(32000)
    assert signal.bandwidth(noise, 16000) == (pytest.approx(8000, abs=20), False)
    narrow = signal.resample(signal.resample(noise, 16000, 8000), 8000, 16000)
    top, up = signal.bandwidth(narrow, 16000)
    assert up and top < 4600


@pytest.mark.parametrize(("rate", "target"), [(44100, 16000), (16000, 24000), (8000, 16000), (16000, 16000)])
def test_resample(rate, target):
    got = signal.resample(tone(300, rate), rate, target)
    assert len(got) == target
    assert np.abs(got[200:-200] - tone(300, target)[200:-200]).max() < 5e-3


def test_prepared_refuses():
    loud = signal.encode_wav(np.ones(10), 16000)
    assert signal.prepared(loud).max() <= 1.0
    with pytest.raises(Exception):
        signal.prepared(b"")


def test_word_errors_of_many_words(spark):
    ref, hyp = " ".join(f"a{i}" for i in range(4000)), " ".join(f"b{i}" if i % 2 else f"a{i}" for i in range(5000))
    df = spark.createDataFrame([(1, ref, hyp), (2, "x y z", "x z"), (3, "x y", None)], "id int, r string, h string")
    got = {r["id"]: r["wer"] for r in df.select("id", text.error_rates(F.col("r"), F.col("h"))[0].alias("wer")).collect()}
    assert got == pytest.approx({1: 3000 / 4000, 2: 1 / 3, 3: 1.0})

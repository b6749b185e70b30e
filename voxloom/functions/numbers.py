"""Numeric expressions: rates, levels, interpolation, vectors and tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, nonspace_count, strip_text, word_count

#: What a clip that failed gets in a column of numbers.
NAN_VALUE = float("nan")
#: The WADA curve, one value for each dB from -20 to 100.
WADA_FIRST_DB = -20
WADA_CURVE = (
    0.40974774, 0.40986926, 0.40998566, 0.40969089, 0.40986186, 0.40999006, 0.41027138, 0.41052627, 0.41101024, 0.41143264, 0.41231718,
    0.41337272, 0.41526426, 0.4178192, 0.42077252, 0.42452799, 0.42918886, 0.43510373, 0.44234195, 0.45161485, 0.46221153, 0.47491647,
    0.48883809, 0.50509236, 0.52353709, 0.54372088, 0.56532427, 0.58847532, 0.61346212, 0.63954496, 0.66750818, 0.69583724, 0.72454762,
    0.75414799, 0.78323148, 0.81240985, 0.84219775, 0.87166406, 0.90030504, 0.92880418, 0.95655449, 0.9835349, 1.01047155, 1.0362095,
    1.06136425, 1.08579312, 1.1094819, 1.13277995, 1.15472826, 1.17627308, 1.19703503, 1.21671694, 1.23535898, 1.25364313, 1.27103891,
    1.28718029, 1.30302865, 1.31839527, 1.33294817, 1.34700935, 1.3605727, 1.37345513, 1.38577122, 1.39733504, 1.40856397, 1.41959619,
    1.42983624, 1.43958467, 1.44902176, 1.45804831, 1.46669568, 1.47486938, 1.48269965, 1.49034339, 1.49748214, 1.50435106, 1.51076426,
    1.51698915, 1.5229097, 1.528578, 1.53389835, 1.5391211, 1.5439065, 1.54858517, 1.55310776, 1.55744391, 1.56164927, 1.56566348,
    1.56938671, 1.57307767, 1.57654764, 1.57980083, 1.58304129, 1.58602496, 1.58880681, 1.59162477, 1.5941969, 1.59693155, 1.599446,
    1.60185011, 1.60408668, 1.60627134, 1.60826199, 1.61004547, 1.61192472, 1.61369656, 1.61534074, 1.61688905, 1.61838916, 1.61985374,
    1.62135878, 1.62268119, 1.62390423, 1.62513143, 1.62632463, 1.6274027, 1.62842767, 1.62945532, 1.6303307, 1.63128026, 1.63204102,
)


def parse_number(value: Column) -> Column:
    """A double, or null where there is none; nan and inf parse, trailing type letters don't."""
    return F.when(~F.lower(value.cast("string")).rlike("[df]$") | F.lower(value.cast("string")).rlike("inf$"), value.try_cast("double"))


def sentinel_to_null(value: Column) -> Column:
    """Null for null, NaN and negative values: those mark a clip that could not be scored."""
    return F.when(~F.isnan(value) & (value >= 0), value)


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def ieee_divide(a: Column, b: Column) -> Column:
    """a / b as doubles, by zero too: infinity, or NaN for zero by zero. Spark's own division by zero is an error."""
    return F.when(b == 0, a * F.lit(float("inf"))).otherwise(a / F.nullif(b, F.lit(0)))


def speaking_rates(text: Column, duration: Column) -> Column:
    """A struct of speaking_rate, phonemes_per_word and char_rate, characters standing in for phonemes. The
    stripped text and its counts are computed once a row."""
    timed = F.coalesce(duration > 0, F.lit(False))

    def rates(clean: Column) -> Column:
        counts = F.struct(nonspace_count(clean).alias("units"), word_count(clean).alias("words"), F.length(clean).alias("chars"))
        return let(counts, lambda n: F.struct(
            F.when(timed & (n["chars"] > 0), n["units"] / duration).otherwise(0.0).alias("speaking_rate"),
            F.when(timed & (n["words"] > 0), F.try_divide(n["units"], n["words"])).otherwise(0.0).alias("phonemes_per_word"),
            F.when(timed, n["chars"] / duration).otherwise(0.0).alias("char_rate"),
        ))

    return let(strip_text(F.coalesce(text, F.lit(""))), rates)


def expressiveness(pitch_mean: Column, pitch_std: Column) -> Column:
    return F.when(pitch_mean > 0, pitch_std / pitch_mean).otherwise(0.0)


def level_db(rms: Column) -> Column:
    return 20 * F.log10(F.greatest(rms, F.lit(1e-8)))


def interpolate(value: Column, curve: tuple[float, ...] = WADA_CURVE, first: float = WADA_FIRST_DB) -> Column:
    """The place of value on a curve of unit steps from `first`: at the last entry below it,
    linear up to the next; `first` where none is below, the end where all are."""
    last = len(curve) - 1
    table = F.array(*[F.lit(float(x)) for x in curve])

    def place(v: Column) -> Column:
        # the curve isn't monotonic at its start, so the last entry below is looked for, not the first above
        below = F.aggregate(F.sequence(F.lit(0), F.lit(last)), F.lit(-1), lambda best, i: F.when(table[i] < v, i).otherwise(best))
        line = lambda k: first + k + (v - table[k]) / F.nullif(table[F.least(k + 1, F.lit(last))] - table[k], F.lit(0.0))
        return let(below, lambda k: F.when(k < 0, float(first)).when(k == last, float(first + last)).otherwise(line(F.greatest(k, F.lit(0)))))

    return let(value, lambda v: F.when(~F.isnan(v), place(v)))


def wada_snr(samples: Column) -> Column:
    """Blind SNR estimate of an array of samples: null for an empty array, NaN for silence."""
    eps = 1e-10

    def estimate(loud: Column) -> Column:
        level = F.transform(samples, lambda x: F.greatest(F.abs(x).cast("double") / loud, F.lit(eps)))
        # both means in one pass
        start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("l"))
        sums = F.aggregate(level, start, lambda a, x: F.struct((a["s"] + x).alias("s"), (a["l"] + F.ln(x)).alias("l")))
        n = F.size(samples)
        return interpolate(let(sums, lambda t: F.ln(F.greatest(t["s"] / n, F.lit(eps))) - t["l"] / n))

    loudest = F.array_max(F.transform(samples, lambda x: F.abs(x).cast("double")))
    return F.when(F.size(samples) > 0, let(loudest, lambda loud: F.when(loud > 0, estimate(loud)).otherwise(float("nan"))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit_vector(v: Column) -> Column:
    """v over its length; a zero vector stays zero."""
    return let(l2_norm(v), lambda size: F.transform(v, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0))))


def cosine(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b)), F.lit(0.0))


def percent_floor(part: Column, whole: Column) -> Column:
    return F.floor(100 * part / F.greatest(F.lit(1), whole)).cast("long")


def endpoint_within(end_seconds: Column, frames: Column, sample_rate: Column, tolerance_ms: int = 80) -> Column:
    """Whether an end time lies within the file, give or take; exact, in decimals."""
    frames_at = end_seconds.cast("string").cast("decimal(28,10)") * sample_rate.cast("decimal(9,0)")
    return frames_at <= frames + F.floor(sample_rate * tolerance_ms / 1000)

"""The quality report: Spark computes the figures, the driver writes one self-contained page."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..schema import named

WIDTH, HEIGHT, BINS = 640, 150, 48
STYLE = "body{font:15px sans-serif;max-width:1080px;margin:2em auto}td,th{padding:3px 9px;border:1px solid #ccc}.bad{fill:#d77}.good{fill:#79c}.card{display:inline-block;width:310px;margin:4px;vertical-align:top}"


def histogram_svg(counts: dict[int, int], lo: float, hi: float, kind: str, limit) -> str:
    """Bars by bin, those on the failing side tinted, and a line at each limit."""
    ok = {"ge": lambda v: v >= limit, "le": lambda v: v <= limit, "range": lambda v: limit[0] <= v <= limit[1]}[kind]
    step, most = WIDTH / BINS, max([1, *counts.values()])
    bars = []
    for b, n in sorted(counts.items()):
        tall = n / most * (HEIGHT - 8)
        side = "good" if ok(lo + (b + 0.5) / BINS * (hi - lo)) else "bad"
        bars.append(f'<rect class="{side}" x="{b * step:.1f}" y="{HEIGHT - tall:.1f}" width="{step - 1:.1f}" height="{tall:.1f}"/>')
    for t in limit if isinstance(limit, tuple) else (limit,):
        x = (t - lo) / (hi - lo) * WIDTH
        bars.append(f'<path d="M{x:.1f} 0V{HEIGHT}" stroke="#b00" stroke-dasharray="4 3"/><text x="{x + 3:.1f}" y="11" font-size="11">{t:g}</text>')
    return f'<svg viewBox="0 0 {WIDTH} {HEIGHT}" width="{WIDTH}">{"".join(bars)}</svg>'


def _card(row: dict, note: str) -> str:
    sound = f'<audio controls src="{row["audio"]}"></audio>' if row.get("audio") else ""
    text = html.escape((row.get("text") or "").strip()[:140])
    return f'<div class="card">{sound}<b>{html.escape(str(row.get("id")))} {html.escape(note)}</b><br><i>{text}</i></div>'


def report(df: DataFrame, title: str, limits: quality.Thresholds = quality.Thresholds(), samples: int = 5, human: bool = False, asr: bool = False) -> str:
    """A page with the summary, drop reasons, each metric's distribution and shares, clips next to the
    limits and sampled clips. A column `audio` of data URLs makes clips playable. What reaches
    the driver is a few rows a metric."""
    df = df.withColumn("id", named("id").cast("string"))
    s = quality.summary(df, limits).first()
    out = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>{STYLE}</style><h1>{html.escape(title)}</h1>"]
    out.append(f"<p>{s['clips']:,} clips, {s['hours']:.1f} hours, {s['speakers']:,} speakers, {s['kept_percent']}% kept</p><h2>Drop reasons</h2><table>")
    for r in quality.reason_counts(df, limits).orderBy(F.desc("clips"), "reason").collect():
        out.append(f"<tr><td>{r['reason']}<td>{r['clips']:,}<td>{r['percent']:.1f}%</tr>")
    out.append("</table>")
    metrics = [m for m in quality.metric_limits(limits, human, asr) if m[0] in df.columns]
    shares = {r["metric"]: r for r in quality.fail_shares(df, metrics).collect()} if metrics else {}
    shown = [x for x in ("id", "text", "audio") if x in df.columns]
    for column, label, kind, limit in metrics:
        r = shares[column]
        have = r["clips"] - r["missing"]
        if not have:
            out.append(f"<h2>{label}</h2><p>no data</p>")
            continue
        values = df.select(quality.sentinel_to_null(named(column).cast("double")).alias("v"))
        ends = [x["value"] for x in quality.nearest_rank(values, "v", [0.005, 0.995]).collect()]
        bounds = [*ends, *(limit if isinstance(limit, tuple) else (limit,))]
        lo, hi = min(bounds), max(bounds)
        hi = hi if hi > lo else lo + 1
        counts = {x["bin"]: x["clips"] for x in quality.histogram(values, "v", limit, BINS).collect()}
        out.append(f"<h2>{label}</h2><p>failing {100 * r['failing'] / have:.1f}%, missing {100 * r['missing'] / r['clips']:.1f}%</p>{histogram_svg(counts, lo, hi, kind, limit)}")
        near = quality.near_limit(df.select(*shown, column), column, kind, limit, samples, "id").collect()
        for side, name in ((False, "Rejected"), (True, "Accepted")):
            out.append(f"<h3>{name}, next to the limit</h3>" + "".join(_card(x.asDict(), f"{column}={x[column]:g}") for x in near if x["passing"] == side))
    marked = quality.with_reasons(df, limits).select(*shown, "reasons")
    for good, name in ((True, "Accepted"), (False, "Rejected")):
        rows = quality.sample(marked.where((F.size("reasons") == 0) == F.lit(good)), "id", samples).collect()
        out.append(f"<h2>{name}, sampled</h2>" + "".join(_card(x.asDict(), " ".join(x["reasons"])) for x in rows))
    return "\n".join(out)

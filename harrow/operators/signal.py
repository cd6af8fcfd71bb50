"""Per-file signal features as a Spark job.

The time-domain features (RMS energy, loudness in dB, zero-crossing rate) are Spark
higher-order array functions: they run in the JVM on each row's sample array, with
the framing rules of the common audio toolkits (centred frames of 2048 samples, hop
512; zero padding for RMS, edge padding for the crossing rate).  Spectral features are
not computed; a table that carries them keeps them (see the README).
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.functions.columns import SIGNAL_FEATURES

# Fixed values of the feature definitions.
SAMPLE_RATE = 22050
FRAME_LENGTH = 2048
HOP_LENGTH = 512
AMIN = 1e-5
TOP_DB = 80.0
ZC_THRESHOLD = 1e-10
TIME_FEATURES = ("energy", "loudness_db", "zcr")


def _n_frames(n: Column) -> Column:
    pad = FRAME_LENGTH // 2
    return F.floor((n + 2 * pad - FRAME_LENGTH) / HOP_LENGTH).cast("int") + 1


def rms_frames(samples: Column) -> Column:
    """RMS per centred frame, zero padded: array<double>."""
    n = F.size(samples)
    pad = FRAME_LENGTH // 2

    def frame(t):
        lo = F.greatest(t * HOP_LENGTH - pad, F.lit(0))
        hi = F.least(t * HOP_LENGTH - pad + FRAME_LENGTH, n)
        part = F.slice(samples, lo + 1, F.greatest(hi - lo, F.lit(0)))
        ss = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x * x)
        return F.sqrt(ss / FRAME_LENGTH)
    return F.transform(F.sequence(F.lit(0), _n_frames(n) - 1), frame)


def zcr_frames(samples: Column) -> Column:
    """Zero-crossing rate per centred frame, edge padded: array<double>."""
    n = F.size(samples)
    pad = FRAME_LENGTH // 2
    neg = lambda i: F.get(samples, i) < -ZC_THRESHOLD

    def frame(t):
        lo = F.greatest(t * HOP_LENGTH + 1 - pad, F.lit(1))
        hi = F.least(t * HOP_LENGTH + FRAME_LENGTH - 1 - pad, n - 1)
        idx = F.sequence(lo, F.greatest(hi, lo))
        crossings = F.size(F.filter(idx, lambda i: (i <= hi) & (neg(i) != neg(i - 1))))
        return F.when(hi >= lo, crossings).otherwise(F.lit(0)) / FRAME_LENGTH
    return F.transform(F.sequence(F.lit(0), _n_frames(n) - 1), frame)


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def time_domain_features(df: DataFrame, samples: str) -> DataFrame:
    """G1 (time domain): energy, loudness_db, zcr; all in the JVM."""
    x = F.col(samples).cast("array<double>")
    rms = rms_frames(x)
    db = F.transform(rms, lambda r: 20 * F.log10(F.greatest(r, F.lit(AMIN))))
    top = F.array_max(db)
    clipped = F.transform(db, lambda d: F.greatest(d, top - TOP_DB))
    return df.withColumns({
        "energy": _mean(rms),
        "loudness_db": _mean(clipped),
        "zcr": _mean(zcr_frames(x)),
    })


def zero_features(df: DataFrame, warning: str | None = None) -> DataFrame:
    """Absent or failed signal features become 0.0; the reason goes to
    ``audio_warning``."""
    cols = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
            for c in SIGNAL_FEATURES}
    any_missing = None
    for c in SIGNAL_FEATURES:
        m = F.col(c).isNull() if c in df.columns else F.lit(True)
        any_missing = m if any_missing is None else any_missing | m
    reason = F.lit(warning or "audio features unavailable")
    out = df.withColumn("audio_warning", F.when(any_missing, reason).otherwise(
        F.col("audio_warning") if "audio_warning" in df.columns else F.lit(None).cast("string")))
    return out.withColumns(cols)


def decode_wav(content: bytes) -> tuple[list[float] | None, str | None]:
    """PCM WAV bytes to mono samples in [-1, 1], or the reason why not.  Only 8, 16 and
    32 bits at the features' sample rate are read: frames of another rate would mean other
    times."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            rate, ch, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
            raw = w.readframes(w.getnframes())
    except (wave.Error, EOFError) as exc:
        return None, f"not a readable WAV file: {exc}"
    if rate != SAMPLE_RATE:
        return None, f"sample rate {rate}, expected {SAMPLE_RATE}"
    if width not in (1, 2, 4):
        return None, f"{8 * width}-bit samples are not read"
    x = np.frombuffer(raw, {1: np.uint8, 2: np.int16, 4: np.int32}[width]).astype(np.float64)
    x = (x - 128) / 128.0 if width == 1 else x / float(2 ** (8 * width - 1))
    return (x.reshape(-1, ch).mean(axis=1) if ch > 1 else x).tolist(), None


def decode_wav_column(df: DataFrame, content: str = "content", out: str = "samples",
                      warning: str = "audio_warning") -> DataFrame:
    """WAV bytes from the binaryFile source to ``array<double>`` samples, and the reason
    where a file cannot be decoded (one pandas UDF)."""
    schema = T.StructType([T.StructField("s", T.ArrayType(T.DoubleType())),
                           T.StructField("w", T.StringType())])

    @F.pandas_udf(schema)
    def dec(col: pd.Series) -> pd.DataFrame:
        rows = [decode_wav(bytes(b)) if b is not None else (None, "no content") for b in col]
        return pd.DataFrame({"s": pd.Series([r[0] for r in rows], dtype=object),
                             "w": pd.Series([r[1] for r in rows], dtype=object)})
    return (df.withColumn("__dec", dec(F.col(content)))
            .withColumns({out: F.col("__dec.s"), warning: F.col("__dec.w")}).drop("__dec"))

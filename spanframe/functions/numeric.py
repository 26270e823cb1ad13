"""Numeric column expressions: thresholds, activations, losses, vectors."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold(c, th: float, inclusive: bool = True) -> Column:
    """0/1 with an explicit convention: ``>=`` (inclusive) or ``>``."""
    c = _c(c)
    return F.when(c >= th if inclusive else c > th, 1).otherwise(0)


def rounded(c, digits: int = 6) -> Column:
    """``round(c, digits)`` of a double, half up, without a decimal number made for each value.

    The nearest whole number over a power of ten is what the decimal way gives,
    but where the value lies near a half or is large, null or no number: there
    it is rounded as a decimal.  ``c`` is read several times, so it should be a
    column."""
    return F.coalesce(rounded_if_plain(c, digits), F.round(c, digits))


def rounded_if_plain(c, digits: int = 6, safe: Column | None = None) -> Column:
    """``rounded`` where the value, and ``safe`` if given, leave no doubt how; else null."""
    c, unit = _c(c), 10.0 ** digits
    scaled = c * unit
    plain = (F.abs(scaled) < 1e9) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain if safe is None else safe & plain, F.floor(scaled + 0.5) / F.lit(unit))


def vec_sum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x)


def vec_abs_sum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + F.abs(x))


def sigmoid(z) -> Column:
    z = _c(z)
    return 1.0 / (1.0 + F.exp(-z))


def logit(p) -> Column:
    p = _c(p)
    return F.ln(p / (1.0 - p))


def softplus(z) -> Column:
    """log(1 + exp(z)) computed stably."""
    z = _c(z)
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def bce(p, y, eps: float = 1e-7) -> Column:
    """Binary cross-entropy on probabilities (clipped)."""
    p = F.least(F.greatest(_c(p), F.lit(eps)), F.lit(1 - eps))
    y = _c(y)
    return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))


def bce_with_logits(z, y, pos_weight: float = 1.0) -> Column:
    """BCE on logits: pos_weight * y * softplus(-z) + (1 - y) * softplus(z)."""
    z, y = _c(z), _c(y)
    return F.lit(pos_weight) * y * softplus(-z) + (1 - y) * softplus(z)


def softmax(arr) -> Column:
    """Softmax over an array<double> with max shift."""
    a = _c(arr)
    m = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / tot)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is made once: a value named inside a lambda would be made for each item."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def logsumexp(arr) -> Column:
    """Log of the sum of exponentials of an array<double> with max shift, linear in its length.

    A list of columns is taken as an array of them, without a lambda, which would not be compiled."""
    if isinstance(arr, list):
        m = F.greatest(*arr)
        return m + F.ln(reduce(lambda acc, x: acc + F.exp(x - m), arr, F.lit(0.0)))
    a = _c(arr)
    return _bound(F.array_max(a), lambda m: m + F.ln(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))))


def log_softmax(arr) -> Column:
    a = _c(arr)
    return _bound(logsumexp(a), lambda lse: F.transform(a, lambda x: x - lse))


def nll(log_probs, label) -> Column:
    """Negative log-likelihood of the class ``label`` (0-based) in an array of log-probabilities."""
    return -F.get(_c(log_probs), _c(label))


def cross_entropy(logits, label) -> Column:
    """Cross-entropy of the class ``label`` (0-based) in an array, or a list of columns, of logits."""
    if isinstance(logits, list):
        return -(F.get(F.array(*logits), _c(label)) - logsumexp(logits))
    return nll(log_softmax(logits), label)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))


def cosine_similarity(a, b) -> Column:
    return dot(a, b) / (norm2(a) * norm2(b))


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def normalize_vec(a, mean: float, std: float) -> Column:
    return F.transform(_c(a), lambda x: (x - mean) / std)


def denormalize_clip(a, mean: float, std: float) -> Column:
    """Inverse of :func:`normalize_vec` clipped to [0, 1]."""
    return F.transform(_c(a), lambda x: F.least(F.greatest(x * std + mean, F.lit(0.0)), F.lit(1.0)))


def format_minutes(sec) -> Column:
    """``asMinutes``: ``'%dm %ds'`` of whole minutes and remaining seconds."""
    s = _c(sec)
    m = F.floor(s / 60)
    return F.format_string("%dm %ds", m.cast("long"), F.floor(s - m * 60).cast("long"))


def time_since(elapsed_sec, share) -> Column:
    """``timeSince``: elapsed time and what remains at this pace, from the share done."""
    s = _c(elapsed_sec)
    return F.format_string("%s (remain %s)", format_minutes(s), format_minutes(s / _c(share) - s))


def cosine_warmup_lr(step, base_lr: float, warmup: int, total, cycles: float = 0.5) -> Column:
    """Linear warm-up then cosine decay (as a function of the step)."""
    st = _c(step).cast("double")
    prog = (st - warmup) / F.greatest(F.lit(1.0), _c(total) - float(warmup))
    cos = F.greatest(F.lit(0.0), 0.5 * (1.0 + F.cos(F.lit(math.pi) * 2.0 * cycles * prog)))
    return F.when(st < warmup, st / F.lit(float(max(1, warmup))) * base_lr).otherwise(cos * base_lr)


def linear_warmup_lr(step, base_lr: float, warmup: int, total) -> Column:
    st = _c(step).cast("double")
    dec = F.greatest(F.lit(0.0), (_c(total) - st) / F.greatest(F.lit(1.0), _c(total) - float(warmup)))
    return F.when(st < warmup, st / F.lit(float(max(1, warmup))) * base_lr).otherwise(dec * base_lr)


def step_decay_lr(epoch, base_lr: float, step_size: int, gamma: float) -> Column:
    return F.lit(base_lr) * F.pow(F.lit(gamma), F.floor(_c(epoch) / step_size))


def exp_decay_lr(epoch, base_lr: float = 1e-3, factor: float = 0.6) -> Column:
    return F.lit(base_lr) * F.pow(F.lit(factor), _c(epoch))

"""Log format and detector option objects, validated on the driver."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class LogFormat:
    """Where the parser finds things in a request-log line.

    The markers and label keys are whatever the logging filter of the
    serving proxy writes; set them to your producer's values. The defaults
    are this build's own log format (used by the fixtures).
    """

    # Fixed values of the log format (defaults of this build's fixtures; the
    # labels field is the mesh proxy's label metadata field).
    request_marker: str = "FilterOnRequest:"
    response_marker: str = "FilterOnResponse:"
    labels_field: str = "ISTIO_METAJSON_LABELS"
    app_label: str = "app"
    model_id_label: str = "deployer"
    model_label: str = "stable-app"
    axon_label: str = "axon"
    proxy_suffix: str = "-proxy"
    predict_path: str = "/predict"


# Cloud-logging severity names in rank order (fixed values of the log model).
SEVERITY_ORDER = ["DEFAULT", "DEBUG", "INFO", "NOTICE", "WARNING", "ERROR", "CRITICAL", "ALERT", "EMERGENCY"]


def _check_range(name, value, lo, hi):
    if value is None or (isinstance(value, float) and math.isnan(value)) or not (lo <= value <= hi):
        raise ValueError(f"option {name}={value!r} outside [{lo}, {hi}]")


@dataclass(frozen=True)
class Options:
    """Base class: every numeric field declares its allowed range in metadata."""

    def __post_init__(self):
        for f in fields(self):
            rng = f.metadata.get("range")
            if rng:
                _check_range(f.name, getattr(self, f.name), *rng)


def opt(default, lo, hi):
    return field(default=default, metadata={"range": (lo, hi)})


BIG = float("inf")

# The defaults and bounds below are those of the job vocabulary and of the published methods.


@dataclass(frozen=True)
class CusumOptions(Options):
    min_n: int = opt(30, 0, BIG)
    delta: float = opt(0.005, 0.0, 1.0)
    lam: float = opt(50.0, 0.0, BIG)


@dataclass(frozen=True)
class PageHinkleyOptions(Options):
    min_n: int = opt(30, 0, BIG)
    delta: float = opt(0.005, 0.0, 1.0)
    lam: float = opt(50.0, 0.0, BIG)
    alpha: float = opt(1 - 0.0001, 0.0, 1.0)


@dataclass(frozen=True)
class GmaOptions(Options):
    min_n: int = opt(30, 0, BIG)
    lam: float = opt(1.0, 0.0, BIG)
    alpha: float = opt(0.99, 0.0, 1.0)


@dataclass(frozen=True)
class DdmOptions(Options):
    min_n: int = opt(30, 0, BIG)
    warn_level: float = opt(2.0, 1.0, 4.0)
    out_level: float = opt(3.0, 1.0, 5.0)


@dataclass(frozen=True)
class EddmOptions(Options):
    min_n: int = opt(30, 0, BIG)
    min_events: int = opt(30, 0, BIG)
    warn_ratio: float = opt(0.95, 0.0, 1.0)
    out_ratio: float = opt(0.90, 0.0, 1.0)


@dataclass(frozen=True)
class EwmaOptions(Options):
    min_n: int = opt(30, 0, BIG)
    lam: float = opt(0.2, 0.0, BIG)


@dataclass(frozen=True)
class HddmAOptions(Options):
    drift_conf: float = opt(0.001, 0.0, 1.0)
    warn_conf: float = opt(0.005, 0.0, 1.0)
    two_sided: bool = True


@dataclass(frozen=True)
class HddmWOptions(Options):
    drift_conf: float = opt(0.001, 0.0, 1.0)
    warn_conf: float = opt(0.005, 0.0, 1.0)
    lam: float = opt(0.05, 0.0, 1.0)
    two_sided: bool = False


@dataclass(frozen=True)
class AdwinOptions(Options):
    delta: float = opt(0.002, 0.0, 1.0)
    clock: int = opt(32, 1, BIG)
    min_side: int = opt(5, 1, BIG)
    exact: bool = False         # True: every split (quadratic, whole window kept); else exponential histogram of blocks of ``clock`` rows
    buckets: int = opt(5, 2, 64)


@dataclass(frozen=True)
class SeedOptions(Options):
    delta: float = opt(0.05, 0.0, 1.0)
    block: int = opt(32, 32, 256)
    eps_prime: float = opt(0.01, 0.0025, 0.01)
    alpha: float = opt(0.8, 0.2, 0.8)
    compress: int = opt(75, 50, 100)


@dataclass(frozen=True)
class SeqDrift1Options(Options):
    delta: float = opt(0.01, 0.0, 1.0)
    warn_delta: float = opt(0.1, 0.0, 1.0)
    block: int = opt(200, 100, 10000)


@dataclass(frozen=True)
class KlOptions(Options):
    window: int = opt(10, 1, BIG)
    bins: int = opt(5, 1, 10)
    lo: float = 0.0
    hi: float = 5.0

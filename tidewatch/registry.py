"""Detector configuration in the reference job's vocabulary.

A job configuration names a detector family by prefix and a detector by
name; ensembles add a univariate detector, its options and a threshold:

    {"drift_detector_type": "MOA_SUBSAMPLE_SIMPLE_MAJORITY",
     "univariate_detector_type": "CUSUM",
     "univariate_detector_options": {"minNumInstancesOption": {"type": "IntOption", "value": 300}, ...},
     "threshold": 0.01}

``detector_from_conf`` turns it into a validated, picklable factory (and
whether it takes whole vector rows). Unknown names, unknown options and
values outside an option's range raise ``ValueError`` on the driver, before
any job starts.
"""

from __future__ import annotations

from functools import partial

from tidewatch.operators.detectors import make_detector
from tidewatch.operators.kl import KlKmeansRows
from tidewatch.operators.vector import vector_factory

# Detector names and option names of the job-configuration vocabulary.
VECTOR_KL = {"MOA_KL": (10, 5), "MOA_SPLL2": (100, 1)}
ENSEMBLES = {"MOA_SUBSAMPLE_SIMPLE_MAJORITY": "majority", "MOA_SUBSAMPLE_LOGISTIC_DECAY": "logistic"}
PER_FEATURE = {"SKMULTIFLOW_EDDM": "EDDM", "SKMULTIFLOW_PageHinkley": "PAGE_HINKLEY",
               "SKMULTIFLOW_DDM": "DDM", "SKMULTIFLOW_ADWIN": "ADWIN"}
UNIVARIATE_NAMES = ["CUSUM", "ADWIN", "GEOMETRIC_MOVING_AVERAGE", "DDM", "EDDM", "EWMA", "PAGE_HINKLEY",
                    "HDDM_A", "HDDM_W", "SEED", "SEQ1"]
OPTION_FIELDS = {
    "minNumInstancesOption": "min_n", "deltaOption": "delta", "lambdaOption": "lam", "alphaOption": "alpha",
    "warningLevelOption": "warn_level", "outcontrolLevelOption": "out_level",
    "driftConfidenceOption": "drift_conf", "warningConfidenceOption": "warn_conf",
    "oneSidedTestOption": "two_sided", "deltaAdwinOption": "delta",
    "deltaSEEDOption": "delta", "blockSizeSEEDOption": "block", "epsilonPrimeSEEDOption": "eps_prime",
    "alphaSEEDOption": "alpha", "compressTermSEEDOption": "compress",
    "deltaWarningOption": "warn_delta", "blockSeqDriftOption": "block",
}
# choice index -> two-sided test? (the choices are listed as one-sided, two-sided)
TWO_SIDED_CHOICE = {0: False, 1: True}


def univariate_options(name: str, options: dict | None) -> dict:
    """Option dicts ``{OptionName: {"type": ..., "value": v}}`` -> our fields."""
    out = {}
    for opt_name, spec in (options or {}).items():
        if opt_name not in OPTION_FIELDS:
            raise ValueError(f"unknown option {opt_name!r} for {name}")
        if not isinstance(spec, dict) or "value" not in spec:
            raise ValueError(f"option {opt_name!r} needs a value")
        v = spec["value"]
        lo, hi = spec.get("min"), spec.get("max")
        if spec.get("type") == "MultiChoiceOption":
            if v not in spec.get("options", list(TWO_SIDED_CHOICE)):
                raise ValueError(f"option {opt_name!r}: choice {v!r} not offered")
            v = TWO_SIDED_CHOICE[int(v)]
        elif (lo is not None and v < lo) or (hi is not None and v > hi):
            raise ValueError(f"option {opt_name!r}={v!r} outside [{lo}, {hi}]")
        field = OPTION_FIELDS[opt_name]
        out[field] = int(v) if spec.get("type") == "IntOption" else v
    make_detector(name, **out)          # our own range checks
    return out


def detector_from_conf(conf: dict):
    """``(factory, vector)`` for a job configuration."""
    kind = conf.get("drift_detector_type")
    if not isinstance(kind, str) or not kind.startswith(("MOA_", "SKMULTIFLOW_")):
        raise ValueError(f"drift detector {kind!r} not implemented")
    if kind in VECTOR_KL:
        w, k = VECTOR_KL[kind]
        return partial(KlKmeansRows, w, k), True
    if kind in PER_FEATURE:
        return vector_factory(PER_FEATURE[kind], {}, "any"), True
    if kind in ENSEMBLES:
        uni = conf.get("univariate_detector_type")
        if uni not in UNIVARIATE_NAMES:
            raise ValueError(f"univariate drift detector {uni!r} not implemented")
        if "univariate_detector_options" not in conf:
            raise ValueError("univariate_detector_options are required for an ensemble")
        if "threshold" not in conf:
            raise ValueError("threshold is required for an ensemble")
        thr = float(conf["threshold"])
        if not 0.0 <= thr <= 1.0:
            raise ValueError(f"threshold {thr} outside [0, 1]")
        opts = univariate_options(uni, conf["univariate_detector_options"])
        return vector_factory(uni, opts, ENSEMBLES[kind], thr), True
    raise ValueError(f"drift detector {kind!r} not implemented")

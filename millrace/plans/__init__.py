"""Stage chains, their runs and configuration."""

from millrace.plans.config import run_config, spec_from_config
from millrace.plans.standardize import RunResult, observed, preview, run, run_once, standardize, with_status

__all__ = ["RunResult", "observed", "preview", "run", "run_config", "run_once", "spec_from_config", "standardize", "with_status"]

from daymark.plans.endpoint import build_endpoint, future, launched
from daymark.plans.template import run_file, run_template

__all__ = ["build_endpoint", "future", "launched", "run_file", "run_template"]

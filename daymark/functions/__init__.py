from daymark.functions.labels import finished_label, phase_label
from daymark.functions.text import entity_key, initcap, lowercase_columns, title_season_name

__all__ = ["entity_key", "finished_label", "initcap", "lowercase_columns", "phase_label", "title_season_name"]

"""The result is defined by these literals, so they are kept together and spelled out."""

# Days.
HORIZON_DAY = 28  # measured and forecast 28-day values
LAUNCH_DAY = 0  # last forecast day that still counts as pre-launch

# Scaling of the measured view share to a percentage.
PERCENT = 100

# Values found in the inputs.
PHASE_POST_LAUNCH = "Post-Launch"
PHASE_PRE_LAUNCH = "Pre-Launch"
SCHEDULE_PAST = "past"
SCHEDULE_ALPHA = "alpha"
CATEGORY_SERIES = "series"
FLAG_FINISHED = 1

# Labels written to the result: where a number came from.
LABEL_ACTUAL = "actual"
LABEL_POSTLAUNCH = "postlaunch"
LABEL_PRELAUNCH = "prelaunch"
LABEL_POSTGREENLIGHT = "postgreenlight"

# Spelling of derived names.
KEY_SEPARATOR = "-"
SEASON_PREFIX = " S"

# Characters after which title case begins a new word: white space and these, the documented default of the dialect.
WORD_ENDS = " \t\n\r\x0b\x0c" + "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

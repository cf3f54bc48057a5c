"""Fixed values.

Values that must equal the reference's for the same results: labels,
default texts, lengths and thresholds of its rules.  They are stated here
once, as plain values; the operators take them as parameters.
"""

# Delivery weeks -- upper day bound of each week and its label.
WEEK_LABELS = [(7, "Prva"), (14, "Druga"), (21, "Treca"), (28, "Cetvrta")]
# Fixed value: deliveries counted up to this many days after the order.
DELIVERY_MAX_DAYS = 28

# Fixed value: default notes text of the publishers table.
DEFAULT_NOTES = "Lorem ipsum"
# Fixed value: default notes text of the titles table.
TITLE_DEFAULT_NOTES = "The quick brown fox jumps over the lazy dog"
# Fixed value: title shown when a person has none.
MISSING_TITLE = "N/A"
# Fixed value: mail domain of the e-mail rule.
MAIL_DOMAIN = "fit.ba"

# Lengths of the NEWID() prefixes the rules take.
PASSWORD_TOKEN_LENGTH = 16
CODE_TOKEN_LENGTH = 20
ORDER_NO_TOKEN_LENGTH = 25
EVIDENCE_TOKEN_LENGTH = 30
SHORT_CODE_LENGTH = 4

# Order numbers shorter than 25 lose their first two characters
# (SUBSTRING(x, 3, 22)).
TRIM_BELOW = 25
TRIM_START = 3
TRIM_LENGTH = 22

# Masked first digits, and the store-id fill rules
# (first digits -> number of trailing digits kept).
MASK_FIRST_DIGITS = ["1", "3"]
STORE_FILL_RULES = [(["4", "5"], 3), (["6", "7"], 4)]

# Rows updated first by the ordered two-step update.
TOP_N = 10

# Text cut of the notes (NVARCHAR(100)) and SUBSTRING(x, 0, 100).
NOTES_LENGTH = 100

# Fixed value: prices whose cents exceed this are rounded up.
ROUND_UP_ABOVE_CENTS = 49

# Products per employee code must exceed this; codes of this
# length are reported and shortened; the code CHECK length.
MIN_PRODUCTS = 2
CODE_LENGTH = 20
CODE_CHECK_LENGTH = 15

# Card view -- trailing card digits kept, and the mail
# password cut SUBSTRING(x, 10, 34).
CARD_DIGITS_KEPT = 11
MAIL_PASSWORD_START = 10
MAIL_PASSWORD_LENGTH = 34

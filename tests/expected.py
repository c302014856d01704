"""Counts the fixture views must reproduce (FIXTURES.md), per scale factor."""

# sessions, events in them, sum of max scroll, sum of duration, one-event sessions
SESSION_COUNTS = {
    "0.001": (364, 786, 8146, 9191995, 122),
    "0.01": (3695, 7910, 85778, 88569731, 1340),
    "0.1": (37325, 79361, 864019, 900126262, 13592),
}

# rows per classifier rule 1..6
RULE_COUNTS = {
    "0.001": (28, 3, 85, 301, 228, 355),
    "0.01": (269, 68, 761, 3190, 2276, 3436),
    "0.1": (2731, 620, 8037, 31076, 22403, 35133),
}

# raw % / calibrated % / inflation % per paid channel
ATTRIBUTION = {
    "0.001": {"Google Ads": (35.7, 39.2, 58.4), "Meta Ads": (28.6, 22.9, 69.6),
              "Bing Ads": (21.4, 22.2, 60.8), "Display": (14.3, 15.7, 58.4)},
    "0.01": {"Google Ads": (35.7, 35.1, 61.8), "Meta Ads": (28.6, 28.9, 60.7),
             "Bing Ads": (21.4, 20.8, 62.2), "Display": (14.3, 15.2, 58.6)},
    "0.1": {"Google Ads": (35.7, 35.6, 61.2), "Meta Ads": (28.6, 28.4, 61.2),
            "Bing Ads": (21.4, 21.7, 60.6), "Display": (14.3, 14.3, 61.0)},
}

# sf0.01: source -> (channel, human rows, value sum); each source has 1,250 raw rows
SOURCE_STATS_SF01 = {
    "google / cpc": ("Google Ads", 478, 71700.0),
    "meta / paid_social": ("Meta Ads", 491, 58920.0),
    "bing / cpc": ("Bing Ads", 472, 42480.0),
    "programmatic / display": ("Display", 518, 31080.0),
    "direct / (none)": ("Direct", 511, 102200.0),
    "(direct) / (none)": ("Direct", 480, 96000.0),
    "google / organic": ("Organic", 518, 93240.0),
    "newsletter / email": ("Other", 483, 48300.0),
}

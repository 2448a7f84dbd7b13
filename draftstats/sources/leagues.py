"""Leagues whose matches are listed by default."""

# Public league ids.
LEAGUE_IDS = (
    16169,
    16201,
    16483,
    16518,
    16669,
    16632,
    16881,
    16901,
    16935,
    17126,
    17272,
    17414,
    17509,
    17588,
    17417,
    17765,
    17891,
    17907,
    17795,
    18058,
)

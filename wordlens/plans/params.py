"""Parameters shared by the registered queries and their SQL oracles."""

# the flagship report threshold (percent)
REPORT_PERCENT = 5
# word used by the position / centring / drill-down queries
WORD = "the"
# word list for the word-list and distance queries (EOS is the end marker surface)
WORDS = ("the", "of", "and", ",", ".", "EOS")
# report rank picked by the drill-down query
DRILL_RANK = 4
# P6 range and P7 length
SUB_START, SUB_STOP = 2, 5
TRIM_LEN = 10
# P8 predicate: binary >= this
FILTER_MIN_BINARY = 100
# Share of sentences a main element must reach
MAIN_SHARE = 0.02
# P3 level window
WINDOW_START, WINDOW_STOP = 0, 3
# T2 after W7
RECENTRED_REPORT_PERCENT = 5
# P9
FILTER_MIN_COUNT = 50
# U4: languages read as already segmented
PRESEGMENTED_LANGUAGES = ("de", "fr")
# U4 mixed: the language that comes as analyser output
ANALYSED_LANGUAGE = "es"
# W9 cube: the number of rows grows with the product of the words' occurrences
CUBE_WORDS = ("the", "EOS")
# analyser features: the short numeral, and forms that stand for a symbol's features
# (padded noun, padded interjection, unclosed quote, unknown type)
SHORT_NUMERAL = "名詞,数詞,*,*,*,*"
SYMBOL_FORMS = {
    "%": "名詞,普通名詞,*,*,*,*",
    "!": "感動詞,*,*,*,*,*",
    "(": '*,"x',
    "=": "*,*",
}
# W9 cells: words with several occurrences and one that many lines lack, and the range of combinations
CELL_WORDS = ("the", "of", "zzz", "and")
CELL_FIRST, CELL_LAST = 2, 40
# documents in one text file of the S1 query
FILE_DOCS = 1000

"""Parameters of the registered queries on the driver's tables.

The driver's ``events`` table is sparse (about 67 events per user over 30
days), so the gaps and deadlines that are seconds in the original jobs are hours or
days here; window sizes and slides are the original ones.  The operators
themselves default to the original constants.
FIXTURES.md lists these values with the row counts they give.
"""

from tidemark.constants import (  # noqa: F401  (re-exported for the oracle)
    BITMAP_LOG2_BITS,
    BITMAP_SEED,
    MSG_LOGIN_BURST,
    MSG_LOGIN_IMMEDIATE,
    MSG_LOGIN_PATTERN,
    MSG_NO_CREATE,
    MSG_NOT_PAYED,
    MSG_PAY_SUCCESS,
)

# how driver columns stand in for the original record fields
ITEM_MOD = 20          # itemId = k % 20
URL_MOD = 10           # url = '/p/' || k % 10
CHANNEL_MOD = 4        # channel = k % 4
PROVINCE_MOD = 5       # province = user_id % 5
AD_MOD = 7             # adId = k % 7

HOT_ITEMS_SIZE_S, HOT_ITEMS_SLIDE_S, HOT_ITEMS_N = 3600, 300, 5
SUMMARY_ITEMS, SUMMARY_KEPT = 16, 10   # fewer than the 20 items, so that some windows need the count of all keys
HOT_PAGES_SIZE_S, HOT_PAGES_SLIDE_S, HOT_PAGES_N = 600, 10, 3
PV_SIZE_S, PV_SLIDE_S = 3600, 300
UV_TUMBLE_S = 3600
HLL_RSD, HLL_BOUND = 0.01, 0.05   # the estimate lies within 5 standard errors of the exact count
CHANNEL_SIZE_S, CHANNEL_SLIDE_S, CHANNEL_BEHAVIOR = 86400, 10, "error"
AD_MAX_CLICKS = 1       # events are sparse: a user's clicks on one ad and day
AD_DAY_OFFSET_S = 8 * 3600
PROVINCE_SIZE_S, PROVINCE_SLIDE_S = 86400, 5
LOGIN_GAP_S = 6 * 3600
LOGIN_CUT_ROWS = 20      # users with more logins are cut, in the query that shows it
UV_DAY_S = 86400
BURST_MIN_FAILS, BURST_WINDOW_S = 2, 86400
ORDER_TIMEOUT_S = 86400
ORDER_MATCH_S = 86400
TX_JOIN_BEFORE_S, TX_JOIN_AFTER_S = 3 * 3600, 5 * 3600
TX_MATCH_WAIT_S = 3 * 86400
LATE_TUMBLE_S, LATE_DELAY_S, LATE_LATENESS_S = 3600, 64, 60
LATE_CUT_ROWS = 1000    # rows a chunk, in the query that shows the cut scan without a key

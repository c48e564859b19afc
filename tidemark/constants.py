"""Fixed values that must equal the original jobs' output for results to match.

Fixed values (stated once, in natural order):
* order/payment result messages: "pay success", "create but not payed",
  "payed but not found create"
* pattern-match messages: "pay" for a create followed by its pay in time,
  "pay timeout" for a create whose pay did not come in time
* repeated-login-failure message of the pattern: "重复登录失败" ("repeated login
  failure"); of the timer: "失败{n}次" ("failed n times"); of the immediate alert: empty
* top-N report header "窗口结束时间：" ("window end time: "), line
  "NO. {i}: 商品标号:{item}, 热门度:{count}" ("item id", "heat"), separator of 41 "="
* distinct-visitor bitmap: 2^29 bits, polynomial string hash with multiplier 26
* click-fraud day boundary: midnight at UTC+8 (16:00 UTC)
"""

MSG_PAY_SUCCESS = "pay success"
MSG_NOT_PAYED = "create but not payed"
MSG_NO_CREATE = "payed but not found create"
MSG_PATTERN_PAY = "pay"
MSG_PATTERN_TIMEOUT = "pay timeout"
MSG_LOGIN_PATTERN = "重复登录失败"
MSG_LOGIN_BURST = "失败%d次"
MSG_LOGIN_IMMEDIATE = ""
REPORT_HEADER = "窗口结束时间："
REPORT_LINE = "NO. %d: 商品标号:%d, 热门度:%d"
REPORT_SEPARATOR = "=" * 41

BITMAP_LOG2_BITS = 29
BITMAP_SEED = 26
LOCAL_DAY_OFFSET_S = 8 * 3600

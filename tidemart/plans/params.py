"""Fixed parameters of the registered queries (days, windows, scopes).

They are arguments of the operators, chosen so that every query touches a
real share of the fixture data at every scale factor; the oracle SQL uses
the same values.
"""

DAY = "1996-03-15"                       # F1 / W7 / W9 single day
LOWER_DAY = "1997-01-01"                 # F2 lower bound
REPLACE_DAYS = ("1996-03-01", "1996-04-01")        # W10 static list: March 1996
EMPTY_DAYS = ("1996-03-01", "1996-03-08")          # W10 with an empty source: 7 days
TRUNCATED_DELTA_WINDOW = ("1996-04-01 10:00:00", "1996-04-01 11:00:00")  # one hour
PRODUCT_CDC_WINDOW = ("1996-06-01 00:00:00", "1998-01-01 00:00:00")
ORDER_CDC_WINDOW = ("1997-01-01 00:00:00", "1998-01-01 00:00:00")
UNGUARDED_WINDOW = ("1995-10-01 00:00:00", "1996-09-01 00:00:00")
SCOPE_DAY = "1995-06-15"                 # F6 explicit day
SCOPE_AS_OF = "1996-01-02"               # F6 incremental: yesterday = 1996-01-01
SCOPE_FIRST_DAY = "1997-06-01"           # F6 first build lower bound
SCD_FIRST_DAY = "1996-01-01"             # H4 first build lower bound
SCD_AS_OF = "1996-06-02"                 # H4 incremental run (yesterday = 1996-06-01)
DATE_LIST = ("2024-01-05", "2024-01-06", "2024-01-20")  # X8 membership list
HISTORY_END = "2002-01-01"               # after the last product change at any scale
HISTORY_START = "1995-01-01"             # the first product change at any scale
INTERVAL_CUTS = ("1997-01-01", "1999-01-01")  # H11 kept up to date: middle, later and earlier part
LIMIT_ROWS = 10
RETURNED_STATUS = "Returned"
HOURLY_RUNS = (("1996-03-15 06:20:00", 6), ("1996-03-15 12:00:00", 6), ("1996-03-15 12:00:00", 6),
               ("1996-03-15 18:59:59", 6), ("1996-03-16 00:10:00", 6), ("1996-03-16 01:30:00", 1))  # H9 (run time, hours)
LATE_HOURS, LATE_WINDOW = 3, 6           # H9 with late commits: longest delay, hours of a window
LATE_RUNS = ("1996-03-15 06:00:00", "1996-03-15 12:00:00", "1996-03-15 12:00:00", "1996-03-15 18:00:00", "1996-03-16 00:00:00")
CHECKED_DAYS = ("1997-02-01", "1997-03-01")       # Q1/Q2 in flight: days of a refused and an accepted load
REPORT_DAYS = ("1996-03-15", "1996-03-16", "1997-07-01")  # H7 days that are run again
LATE_BEFORE = "1998-01-01 00:00:00"      # T2: changes before this are delivered second

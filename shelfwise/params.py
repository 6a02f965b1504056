"""Query parameters.

The reference's queries name a supplier, a store and a year that exist only in
its own sample data.  Fixed values: the stand-ins below are chosen on the test
tables (see FIXTURES.md section 2).
"""

# fixed values: stand-ins for the reference's literals
YEAR = 1997                          # reference: 2019
SUPPLIER_NAME = "Supplier#000000020"  # reference: 'DJI'
STORE_NAME = "NATION_7"              # reference: 'Tech Haven'
SIGMA = 2                            # Q5: beyond 2 sample standard deviations
TOP_K = 5                            # Q3, Q9: LIMIT 5

# fixed values: the reference's date text format '%m/%d/%y %H:%i' as the
# equivalent Spark datetime pattern and as a layout check: one- or two-digit
# month, day, hour and minute, a two-digit year, nothing before or after
ORDER_DATE_FORMAT = "M/d/yy H:m"
ORDER_DATE_LAYOUT = r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{1,2}$"
# two-digit years: 70-99 are 1970-1999, 00-69 are 2000-2069
TWO_DIGIT_YEAR_PIVOT = 70

# fixed values: raw-string fixture rules (FIXTURES.md section 3)
RAW_DATE_HEADER_EVERY = 97    # order key multiple whose date text is the header text
RAW_DATE_EMPTY_EVERY = 89     # order key multiple whose date text is empty
BAD_PRICE_EVERY = 53          # parts whose price text is unreadable (dirty files)
BAD_PRICE_TEXT = "n/a"
BAD_ID_EVERY = 83             # order key multiple whose customer id is unreadable (dirty files)
BAD_ID_TEXT = "c-"
UNKNOWN_PRODUCT_EVERY = 79    # order key multiple whose product is in no master row (dirty files)
UNKNOWN_PRODUCT_SHIFT = 1_000_000_000
CONFLICT_PART_EVERY = 7       # parts whose supplier name gets the ' Ltd' suffix
STORED_BEFORE = "1997-01-01"  # orders before this day made the stored dimension
GENDER_MAX_LEN = 10           # VARCHAR(10) of the reference
SEGMENT_MAX_LEN = 9           # length limit checked on c_mktsegment
NAME_MAX_LEN = 255            # VARCHAR(255)
UNKNOWN_STORE = 0             # store id of the "unknown" member

"""Regular-expression vocabulary for access-log layouts (Java regex syntax).

These are the public, widely documented log-pattern building blocks (IPv4,
host names, HTTP dates, numbers, URI paths) written as plain Java regular
expressions.  None of them contains a capturing group, so layouts can number
their own captures freely.
"""

# --- fixed values: pattern building blocks --------------------------------
IPV4 = (r"(?<![0-9])(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})\.){3}"
        r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?![0-9])")
IPV6 = (r"(?<![0-9A-Fa-f:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){1,7}|:):(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)"
        r"(?:%[0-9A-Za-z]+)?(?![0-9A-Fa-f:])")
IP = f"(?:{IPV6}|{IPV4})"
# Atomic groups below never change what matches: every use of these tokens is
# followed by a separator the token cannot contain (space, tab, "@"), so a
# shorter match could never succeed; they only stop useless backtracking in
# branches that are going to fail anyway.  The labels repeat possessively, so
# a name of any length is matched without recursion.
HOSTNAME = (r"(?>\b(?:[0-9A-Za-z][0-9A-Za-z-]{0,62})(?:\.(?:[0-9A-Za-z][0-9A-Za-z-]{0,62}))*+"
            r"(?:\.?|\b))")
IPORHOST = f"(?:{IP}|{HOSTNAME})"
USERNAME = r"(?>[a-zA-Z0-9._-]+)"
EMAIL = r"(?>[a-zA-Z0-9._%+-]+)@" + HOSTNAME
HTTPDUSER = f"(?:{EMAIL}|{USERNAME})"
MONTH = (r"\b(?:[Jj]an(?:uary)?|[Ff]eb(?:ruary)?|[Mm]ar(?:ch)?|[Aa]pr(?:il)?|[Mm]ay"
         r"|[Jj]un(?:e)?|[Jj]ul(?:y)?|[Aa]ug(?:ust)?|[Ss]ep(?:t|tember)?|[Oo]ct(?:ober)?"
         r"|[Nn]ov(?:ember)?|[Dd]ec(?:ember)?)\b")
DAY = (r"(?:Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?"
       r"|Sat(?:urday)?|Sun(?:day)?)")
MONTHDAY = r"(?:0[1-9]|[12][0-9]|3[01]|[1-9])"
MONTHNUM = r"(?:0?[1-9]|1[0-2])"
MONTHNUM2 = r"(?:0[1-9]|1[0-2])"
YEAR = r"(?>\d\d){1,2}"
HOUR = r"(?:2[0123]|[01]?[0-9])"
MINUTE = r"(?:[0-5][0-9])"
SECOND = r"(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)"
TIME = f"(?<![0-9]){HOUR}:{MINUTE}(?::{SECOND})(?![0-9])"
INT = r"(?:[+-]?[0-9]+)"
POSINT = r"\b(?:[1-9][0-9]*)\b"
NUMBER = r"(?<![0-9.+-])(?>[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+))"
WORD = r"\b\w+\b"
NOTSPACE = r"\S+"
DATA = r".*?"
GREEDY = r".*"
HTTPDATE = f"{MONTHDAY}/{MONTH}/{YEAR}:{TIME} {INT}"
ISO_TZ = f"(?:Z|[+-]{HOUR}(?::?{MINUTE}))"
TIMESTAMP_ISO8601 = f"{YEAR}-{MONTHNUM}-{MONTHDAY}[T ]{HOUR}:?{MINUTE}(?::?{SECOND})?{ISO_TZ}?"
URIPATH = r"/[A-Za-z0-9$.+!*'(){},~:;=@#%&_\-/]*"  # one class: no recursion on long paths
URIPARAM = r"\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*"
URIPATHPARAM = f"{URIPATH}(?:{URIPARAM})?"
QUOTED_BODY = r'[^"\\]*+(?:\\.[^"\\]*+)*+'  # possessive: no recursion on long fields
# ---------------------------------------------------------------------------

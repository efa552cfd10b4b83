"""Hand-written access-log fixture lines (documentation address ranges only).

Each entry: (line, expected route, expected drop reason or None).
Routes are the quality routes of ``operators.normalise.ROUTES`` plus
``dropped`` for noise.
"""

T = "10/Oct/2023:13:55:36 +0000"
UA = "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0"

HTTPS = [
    ("#Version: 1.0", "dropped", "comment"),
    (f'192.0.2.10 - - [{T}] "GET /data/mgs/vol1/file.img HTTP/1.1" 200 2326 "-" "{UA}"', "processed", None),
    (f'127.0.0.1 - - [{T}] "GET / HTTP/1.1" 200 12 "-" "curl/8.0.1"', "dropped", "loopback"),
    (f'::1 - - [{T}] "OPTIONS * HTTP/1.0" 200 - "-" "Apache/2.4.41 (Ubuntu) (internal dummy connection)"', "dropped", "loopback"),
    (f'192.0.2.11 - - [{T}] "OPTIONS * HTTP/1.0" 200 - "-" "Apache/2.4.41 (Ubuntu) (internal dummy connection)"', "dropped", "dummy_connection"),
    (f'192.0.2.12 - - [{T}] "GET /x\\u001b[31m HTTP/1.1" 404 10 "-" "{UA}"', "dropped", "escaped_control"),
    (f'192.0.2.13 - - [31/Feb/2023:13:55:36 +0000] "GET /a HTTP/1.1" 200 10 "-" "{UA}"', "corrupt", None),
    (f'198.51.100.279 ${{jndi}} - [{T}] "GET /a HTTP/1.1" 200 10 "-" "{UA}"', "corrupt", None),
    (f'192.0.2.14 - - [{T}] "FOO /a HTTP/1.1" 400 10 "-" "{UA}"', "dropped", "invalid_method"),
    (f'192.0.2.15 - - [{T}] "CONNECT example.org:443 HTTP/1.1" 405 10 "-" "{UA}"', "dropped", "invalid_method"),
    (f'192.0.2.16 - - [{T}] "GET /b HTTP/1.1" 200 10 "-" "-"', "processed", None),
    (f'192.0.2.17 ? - [{T}] "GET /c HTTP/1.1" 200 10 "-" "-"', "empty_agent", None),
    (f'192.0.2.18 - - [{T}] "GET /solr/select?fq=a&fq=b&facet.field=x HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.19 - - [{T}] "GET /q?nls[file][foo.nasl][1]=v&_x_=1 HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.20 - - [{T}] "GET /q?q=%zz HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.21 - - [{T}] "GET /noquery HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.22 - - [{T}] "GET /big.tar HTTP/1.1" 200 999999999999 "-" "{UA}"', "processed", None),
    (f'192.0.2.23 - - [{T}] "GET /a b HTTP/1.1" 400 10 "-" "{UA}"', "processed", None),
    (f'2001:db8::1 - - [{T}] "GET /v6 HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.24 - - [{T}] "GET /twice HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.24 - - [{T}] "GET /twice HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    (f'192.0.2.25 - - [{T}] "GET /index.php?allow_url_include=1 HTTP/1.1" 200 10 "-" "{UA}"', "processed", None),
    ("2023-10-10 13:55:36 W3SVC1 192.0.2.1 GET /default.htm page=1 80 - 198.51.100.7 Mozilla/5.0+(Windows+NT+10.0) 200 0 0 5120 31",
     "processed", None),
    ("2023-10-10 13:55:36 W3SVC1 192.0.2.1 GET - 80 - 198.51.100.8 Mozilla/5.0+(Windows+NT+10.0) 200 0 0 5120 31",
     "processed", None),
    ("2023-10-10 13:55:36 192.0.2.1 GET /min.htm - 80 - 198.51.100.9 Mozilla/5.0 200 0 0", "processed", None),
    ("2023-10-10 13:55:36 W3SVC2 192.0.2.1 GET /site.htm?x=1 443 - 198.51.100.10 Mozilla/5.0 200 0 0 100 20 7",
     "processed", None),
    (f'192.0.2.26 - - [{T}] "GET /common HTTP/1.0" 200 77', "processed", None),
    (f'crawler.example.org - - [{T}] "GET /host HTTP/1.1" 200 5', "processed", None),
    ("this is not a log line", "corrupt", None),
]

FTP = [
    ("Tue Oct 10 13:55:36 2023 1 192.0.2.30 1048576 /pub/atm/data.tab b _ o r 1001 ftp 0 * c", "processed", None),
    ("Tue Oct  3 01:02:03 2023 12 192.0.2.31 999999999999 /pub/big.tar b _ o r 1001 ftp 0 * c", "processed", None),
    (f'192.0.2.32 - - [{T}] "STOR /incoming/x.bin HTTP/1.1" - 10 "-" "-"', "dropped", "ftp_non_retrieval"),
    (f'192.0.2.33 - - [{T}] "LIST /pub HTTP/1.1" - 10 "-" "-"', "dropped", "ftp_non_retrieval"),
    (f'192.0.2.34 - - [{T}] "RETR /pub/file.zip HTTP/1.1" - 10 "-" "-"', "processed", None),
    ("2023-10-10 13:55:36 198.51.100.7 anonymous FTPSVC1 192.0.2.1 21 RETR /pub/file.zip 226 0 1024 64 15", "processed", None),
    ("2023-10-10 13:55:36 198.51.100.7 anonymous FTPSVC1 192.0.2.1 21 STOR /pub/up.zip 226 0 1024 64 15", "dropped", "ftp_non_retrieval"),
    ("2023-10-10 13:55:36 198.51.100.7 anonymous FTPSVC1 192.0.2.1 21 BOTZETR /pub/file.zip 550 0 0 64 15", "processed", None),
    ("Tue Oct 10 13:55:36 2023 1 192.0.2.35", "corrupt", None),
]

CDN_TEXT = [
    ("#Version: 1.0", "dropped", "comment"),
    ("#Fields: date time x-edge-location sc-bytes c-ip cs-method cs(Host) cs-uri-stem sc-status", "dropped", "comment"),
    ("2026-06-25\t00:01:02\tSEA73-P1\t1234\t192.0.2.40\tGET\td1.cdn.example\t/img/a.png\t200\t-\t"
     "Mozilla/5.0%20(X11)\t-\t-\tHit\treq1\twww.example.org\thttps\t300\t0.002\t-\tTLSv1.3", "processed", None),
    ("2026-06-25\t00:01:03\tSEA73-P1\t99\t192.0.2.41\tGET\td1.cdn.example\t/img/b.png\t404\thttps://ref.example/\t"
     "curl/8.0\tsize=2\t-\tError\treq2\twww.example.org\thttps\t300\t0.001\t-\tTLSv1.3", "processed", None),
    ("2026-06-25\t00:01:04\tSEA73-P1\t99\t192.0.2.42\tGET\td1.cdn.example\t/img/c.png\t200\t-\t"
     "-\t-\t-\tHit\treq3\twww.example.org\thttps\t300\t0.001\t-\tTLSv1.3", "empty_agent", None),
]

CDN_JSON = [
    ('{"date":"2026-06-25","time":"00:01:02","c-ip":"192.0.2.50","cs-method":"GET","cs-uri-stem":"/a.png",'
     '"cs-uri-query":"-","sc-status":"200","sc-bytes":"1234","cs-bytes":"300",'
     '"cs(User-Agent)":"Mozilla/5.0%20(X11)","cs(Referer)":"-","c-country":"US","x-host-header":"www.example.org"}',
     "processed", None),
    ('{"date":"2026-06-25","time":"00:01:03","c-ip":"192.0.2.51","cs-method":"GET","cs-uri-stem":"/b.png",'
     '"cs-uri-query":"x=1&x=2","sc-status":"404","sc-bytes":"99","cs-bytes":"300",'
     '"cs(User-Agent)":"curl/8.0","cs(Referer)":"https://ref.example/","c-country":"DE","x-host-header":"www.example.org"}',
     "processed", None),
    ('{"date":"2026-06-25","time":"00:01:04","c-ip":"192.0.2.52","cs-method":"GET","cs-uri-stem":"/c.png",'
     '"cs-uri-query":"-","sc-status":"200","sc-bytes":"99","cs-bytes":"300",'
     '"cs(User-Agent)":"-","cs(Referer)":"-","c-country":"FR","x-host-header":"www.example.org"}',
     "empty_agent", None),
]

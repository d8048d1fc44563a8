"""Names that several core tests share."""

SF = "/root/testdata/sf0.001"
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents"]

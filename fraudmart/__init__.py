"""fraudmart: a Spark-native fraud-reporting warehouse for bank card data.

Daily feeds of transactions, terminals and blacklisted passports are loaded
into validity-dated tables; four fraud rules run over the
client -> account -> card -> transaction chain and feed an accumulating
report mart partitioned by report date.
"""

__all__ = ["session", "schemas"]

"""seqloom: sequence analytics, corpus contracts and gesture analysis as Spark plans."""

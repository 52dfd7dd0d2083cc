"""Operators of a training-data pipeline, one module each.

=====================  ==========================================================================
packing                mixture-controlled packing into fixed windows (deficit round-robin)
token_counts           token counts behind a digest cache
mixing                 entropy balancing of sources towards target weights
fm_dedup               repeated passages by FM-index matching statistics
topk                   exact top-k inner products over norm-sorted blocks
quality                document quality rules and a calibrated n-gram classifier
jaccard                n-gram Jaccard join by T-occurrence search (DivideSkip)
url_filter             URL rules and empirical-Bayes host reputation
sharding               proportional stratified interleaving into shards
suffix_dedup           repeated substrings by a hash-compared suffix sort
structure_repair       conversation repair by weighted CYK parsing over intervals
periodic_runs          periodic runs of words by difference-cover extensions
decontaminate          benchmark passages by an FM-index for every shard
=====================  ==========================================================================

Nothing outside this subpackage imports it. Every operator reads only the columns it names, so
further columns of its input, whatever their names, neither matter nor clash.
"""

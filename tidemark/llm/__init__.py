"""Operators of a training-data pipeline, one module per operator.

==============  ==============================================================
module          operator
==============  ==============================================================
simhash         near-duplicate groups by tiled exact fingerprint comparison
secrets         secret spans: base patterns plus zstandard novelty
bpe             BPE encoding and decoding with a segment tree
html            main text of a page: flat text blocks and a decision tree
ann             nearest neighbours by multiprobe p-stable hashing
quality         document quality from a linear-chain CRF over lines
lm              cross-entropy difference of two n-gram models
maxscore        exact top-k search by MaxScore
mixing          entropy-balanced mixing of sources
langid          language identification by language-bitmask Bloom filters
repair          cheapest conversation repairs by a checkpointed dynamic program
prefixes        token counts at every prefix by dynamic programming
filters         filter interactions by path counts over the subset lattice
queries         the registered ``opN_*`` queries
==============  ==============================================================

Functions that run inside Python workers are sent by value, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

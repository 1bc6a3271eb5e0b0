import os
import sys

for _p in (os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.path.dirname(os.path.abspath(__file__))):
    sys.path.insert(0, _p)

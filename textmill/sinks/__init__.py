"""Writers and table publishing."""

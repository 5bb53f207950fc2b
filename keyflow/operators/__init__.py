"""DataFrame -> DataFrame operators (batch forms; streaming forms live in
``keyflow.streaming``)."""

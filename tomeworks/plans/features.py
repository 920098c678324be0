"""From documents to feature tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.hashing import DEFAULT_BUCKETS
from tomeworks.operators.boilerplate import strip_boilerplate
from tomeworks.operators.eligibility import first_documents
from tomeworks.operators.folds import cyclic_folds
from tomeworks.operators.lookup import BROADCAST_BYTES
from tomeworks.operators.subjects import with_metadata
from tomeworks.operators.terms import term_bags, term_frequencies
from tomeworks.operators.vectors import bag_vectors, bucket_sums, tfidf_vectors
from tomeworks.operators.vocabulary import document_count, document_frequency
from tomeworks.operators.weights import inverse_frequency, tfidf, with_buckets
from tomeworks.sources.sinks import save_by_fold, save_table
from tomeworks.staging import stage


@dataclass(frozen=True)
class Settings:
    """``buckets`` sizes every hashed vector; ``stop_after`` 0 takes all documents."""

    buckets: int = DEFAULT_BUCKETS
    hash_name: str = "md5"
    log_idf: bool = True
    strip: bool = False
    stop_after: int = 0
    cap_before_header_test: bool = False
    broadcast_bytes: int = BROADCAST_BYTES

    @property
    def counting(self) -> tuple:
        """What the bags depend on."""
        return self.strip, self.stop_after, self.cap_before_header_test


class Features:
    """The feature tables of one corpus, each computed when first asked for.

    ``docs`` is (doc_id, text), one row per document.  The bags and the IDF table
    are stage tables, because several later steps read them; the rest stays lazy.
    """

    def __init__(self, docs: DataFrame, settings: Settings = Settings()):
        self.docs = docs
        self.settings = settings

    def staged(self) -> list[DataFrame]:
        """The stage tables made so far."""
        return [self.__dict__[name] for name in ("bags", "idf") if name in self.__dict__]

    @cached_property
    def bodies(self) -> DataFrame:
        """The documents whose terms are counted."""
        s = self.settings
        docs = self.docs
        if s.strip and s.cap_before_header_test:
            return strip_boilerplate(first_documents(docs, s.stop_after))
        if s.strip:
            docs = strip_boilerplate(docs)
        return first_documents(docs, s.stop_after)

    @cached_property
    def bags(self) -> DataFrame:
        return stage(term_bags(self.bodies), "bags")

    @property
    def tf(self) -> DataFrame:
        return term_frequencies(self.bags)

    @property
    def n_docs(self) -> DataFrame:
        return document_count(self.bags)

    @cached_property
    def idf(self) -> DataFrame:
        """(term, df, idf, bucket)."""
        s = self.settings
        idf = inverse_frequency(document_frequency(self.bags), self.n_docs, s.log_idf)
        return stage(with_buckets(idf, s.buckets, s.hash_name), "idf")

    @property
    def tfidf(self) -> DataFrame:
        return tfidf(self.tf, self.idf, self.settings.broadcast_bytes)

    @property
    def tf_buckets(self) -> DataFrame:
        return self.vectors("tf").select("doc_id", F.inline("vec"))

    @property
    def tfidf_buckets(self) -> DataFrame:
        return bucket_sums(self.tfidf, "tfidf")

    def vectors(self, weighting: str = "tfidf") -> DataFrame:
        """(doc_id, vec) for ``tfidf`` or ``tf`` weights."""
        s = self.settings
        if weighting == "tf":
            return bag_vectors(self.bags, s.buckets, s.hash_name)
        if weighting == "tfidf":
            return tfidf_vectors(self.bags, self.idf, s.broadcast_bytes)
        raise ValueError(f"no such weighting: {weighting}")

    def manifest(self, metadata: DataFrame) -> DataFrame:
        """(doc_id, subjects, fold) of the documents with terms and metadata; folds
        are dealt over exactly these, so none is left short."""
        counted = self.bags.where(F.col("max_n").isNotNull()).select("doc_id")
        kept = stage(with_metadata(counted, metadata), "kept")
        return kept.join(cyclic_folds(kept), "doc_id")

    def vector_stats(self, manifest: DataFrame) -> DataFrame:
        """(doc_id, fold, buckets, n_words): terms with an IDF per vectorised document."""
        words = self.tfidf.groupBy("doc_id").agg(F.count("*").alias("n_words"))
        return manifest.select("doc_id", "fold", F.lit(self.settings.buckets).alias("buckets")).join(
            words, "doc_id"
        )

    def save(self, folder: str, metadata: DataFrame) -> None:
        """Write every stage below ``folder``: tf, df, idf, manifest, and vectors by fold.

        Later runs read what they need with ``sources.tables.read_features``.
        """
        manifest = stage(self.manifest(metadata), "manifest")
        save_table(self.tf, f"{folder}/tf")
        save_table(self.idf.select("term", "df"), f"{folder}/df")
        save_table(self.idf, f"{folder}/idf")
        save_table(manifest, f"{folder}/manifest")
        by_fold = self.vectors().join(manifest.select("doc_id", "fold"), "doc_id")
        save_by_fold(by_fold, f"{folder}/vectors")

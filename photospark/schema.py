"""Schemas, bit constants, presets and parameters of the photometry tables."""

from __future__ import annotations

from dataclasses import dataclass

PHOTOMETRY = """star_id string, epoch int, btjd double, flux double, flux_error double, quality int, x double, y double,
x_centroid double, y_centroid double, dx_ref double, dy_ref double, flux_r2 double, flux_r3 double, flux_r4 double,
flux_error_r2 double, flux_error_r3 double, flux_error_r4 double"""
CATALOG = """star_id string, ra double, dec double, ref_x double, ref_y double, ref_flux double, nn_dist_arcsec double, nn_flux_ratio double,
contam_ratio_84arcsec double, contam_ratio_126arcsec double, tic_id string, tic_separation_arcsec double"""

# Mask bits in the order in which reasons are named.
QUALITY, INVALID, BAD_EPOCH, OUTLIER_POS, OUTLIER_NEG, EDGE, ARTIFACT, LOW_SNR = (1 << i for i in range(8))
BITS = {"quality": QUALITY, "invalid": INVALID, "bad_epoch": BAD_EPOCH, "outlier_pos": OUTLIER_POS, "outlier_neg": OUTLIER_NEG, "edge": EDGE, "artifact": ARTIFACT, "low_snr": LOW_SNR}
PRESETS = {"minimal": QUALITY | INVALID, "balanced": QUALITY | INVALID | BAD_EPOCH | OUTLIER_POS | ARTIFACT, "strict": 255}
ML_MASKS = {"anomaly": (QUALITY | INVALID | BAD_EPOCH | ARTIFACT, 0.5), "classification": (QUALITY | INVALID | BAD_EPOCH | OUTLIER_POS | EDGE | ARTIFACT, 0.8)}
TRANSIT_BITS = QUALITY | INVALID | BAD_EPOCH
#: (sector, first btjd, last btjd, what), both ends inside.
ARTIFACT_WINDOWS = ((70, 3215.0, 3221.0, "scattered_light"),)
MAD_TO_SIGMA = 1.4826
ARCSEC_PER_PIXEL = 21.0


@dataclass(frozen=True)
class CleanParams:
    """Thresholds of quality control and masking."""

    bad_epoch_scatter_sigma: float = 5.0
    bad_epoch_median_sigma: float = 3.0
    gap_hours: float = 3.0
    least_frac_good: float = 0.5
    quiet_completeness: float = 0.9
    quiet_mad_percentile: float = 0.30
    edge_pixels: float = 50.0
    frame_pixels: float = 2048.0
    outlier_sigma_pos: float = 5.0
    outlier_sigma_neg: float = 10.0
    outlier_points: int = 5
    edge_days: float = 0.5
    snr_threshold: float = 3.0
